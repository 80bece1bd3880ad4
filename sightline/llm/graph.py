"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component = smallest node reachable.

    Each round sends every node to the smallest node next to it and replaces the
    edges by edges between those. A node and the one it is sent to stay joined,
    so nothing falls apart, and the edges are gone after about log(n) rounds. The
    only grouping is a minimum, which combines before the shuffle, so a node
    with any number of edges is no burden. Every round is written, so a lost
    executor costs one round. Loops, repeated edges and rows with a null end are
    allowed; they add nothing. No edges: no rows.
    """
    left = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hop = materialise(
            ends.groupBy("a").agg(F.min("b").alias("low"))
            .select(F.col("a").alias("node"), F.least("a", "low").alias("to")),
            "hops",
        )
        if labels is None:
            labels = hop.withColumnRenamed("to", "component")
        else:
            step = hop.withColumnsRenamed({"node": "component"})
            labels = materialise(
                labels.join(step, "component", "left")
                .select("node", F.coalesce("to", "component").alias("component")),
                "labels",
            )
        left = materialise(
            left.join(hop.toDF("a", "a2"), "a").join(hop.toDF("b", "b2"), "b")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b")).filter("a <> b").distinct(),
            "edges",
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
