"""Exact k nearest neighbours without comparing all pairs.

Candidates are laid in a tree. A node with more than ``leaf_size`` candidates is split
along its longer side at quantiles of its own candidates, so the tree follows the data:
a far-off place and a dense town cost a level, not a depth limit. A quantile's own value
makes a child for itself, so a node of several spots always falls apart; only candidates
at one spot stay together, and those are cut to the k lowest keys first. Only the
candidates of crowded nodes are touched again for the next level.

Queries are laid in a tree of their own, and its leaves, groups of near queries, walk down
the candidates' tree level by level. At each level the nodes in hand, taken by the farthest
corners of group and node, show a distance within which every query of the group has k
candidates; nodes whose nearest corner is beyond that (or beyond the radius) are dropped.
The leaves left are told apart in the same way for each query, and only their candidates
within that distance are compared. With a radius the roots of both trees are cells of its
size, and a group starts from the cells around its own.

Skew: equal distances are ordered by key, so the cut per spot is exact; queries at one
spot are walked once; a leaf and a group hold a bounded number of spots; and the windows
run per group or query over a bounded number of nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import axes, cell_of, check_metric, chord, distance, slack, square
from sightline.operators.relational import asc
from sightline.session import materialise

QUANTILES = 16


def knn_join(
    queries: DataFrame,
    candidates: DataFrame,
    *,
    k: int,
    query_key: str,
    candidate_key: str,
    radius: float | None = None,
    metric: str = "planar",
    leaf_size: int = 64,
    exclude_self: bool = False,
) -> DataFrame:
    """The k nearest candidates of each ``query_key``, nearest first.

    Returns the columns of both sides except x and y, ``distance`` and ``rank``.
    Ties go to the lower candidate key. Several query rows of one key share one
    ranking. With ``exclude_self`` candidates of the query's own key are skipped;
    as many extra candidates are looked up as one key has rows. With ``metric``
    "metres" x and y are lon and lat, and distances are great circles.
    """
    check_metric(metric)
    located = candidates.filter("x is not null and y is not null")
    cand_cols = [n for n in candidates.columns if n not in ("x", "y")]
    ties = [asc(candidate_key), *[asc(n) for n in cand_cols if n != candidate_key]]
    depth_k = k
    if exclude_self:
        depth_k += located.groupBy(candidate_key).count().agg(F.max("count")).first()[0] or 0
    spot = Window.partitionBy("x", "y").orderBy(*ties)
    pts = located.withColumn("_at", F.row_number().over(spot)).filter(F.col("_at") <= depth_k).drop("_at")

    tree = Tree(pts, radius, metric, leaf_size)
    spots = queries.filter("x is not null and y is not null").select(
        F.col("x").alias("qx"), F.col("y").alias("qy")
    ).distinct()
    found = _compare(tree, tree.walk(spots, depth_k), cand_cols, ties, depth_k, radius)
    q = queries.withColumnsRenamed({"x": "qx", "y": "qy"})
    joined = q.join(found, ["qx", "qy"]).drop("qx", "qy")
    if exclude_self:
        joined = joined.filter(F.col(query_key) != F.col(candidate_key))
    per_query = Window.partitionBy(query_key).orderBy(asc("distance"), *ties)
    return joined.withColumn("rank", F.row_number().over(per_query)).filter(F.col("rank") <= k)


class Tree:
    """Candidates (with x, y) in a tree of nodes; ``levels`` are its nodes, ``leaves`` the candidates with their leaf.

    A node is known by its path. Every level is a written table of its own, so a join
    with the few nodes near the root is planned as one with a small table.
    """

    def __init__(self, points: DataFrame, radius: float | None, metric: str, leaf_size: int) -> None:
        self.metric, self.leaf_size, self.radius = metric, leaf_size, radius
        self.dims = 2 if metric == "planar" else 3
        # a little longer than the radius, so that rounding leaves no candidate out
        self.reach = None if radius is None else chord(metric, radius) * (1 + 1e-9) + slack(metric)
        self.around = self.reach is not None and self.reach > 0
        places = axes(metric, F.col("x").cast("double"), F.col("y").cast("double"))
        at = points.withColumns({f"_c{i}": c for i, c in enumerate(places)})
        root = self._cell([F.col(f"_c{i}") for i in range(self.dims)]) if self.around else F.lit("")
        at = materialise(at.withColumn("_node", root), "knn-candidates")
        self.levels = [materialise(self._nodes(at), "knn-roots")]
        parts = []
        while True:
            crowded = self.levels[-1].filter(self._crowded())
            if crowded.isEmpty():
                break
            parts.append(at.join(crowded.select("_node"), "_node", "left_anti"))
            at = materialise(self._split(at, crowded), "knn-split")
            below = self._nodes(at.withColumn("_parent", F.regexp_replace("_node", "/[^/]*$", "")), "_parent")
            self.levels.append(materialise(below, "knn-level"))
        self.leaves = at
        for part in parts:
            self.leaves = self.leaves.unionByName(part)

    def _cell(self, places: Sequence[Column], steps: Sequence[Column] | None = None) -> Column:
        index = [cell_of(c, self.reach) for c in places]
        if steps is not None:
            index = [i + s for i, s in zip(index, steps, strict=True)]
        return F.concat_ws(":", *[i.cast("string") for i in index])

    def _nodes(self, at: DataFrame, *keys: str) -> DataFrame:
        box = [f(f"_c{i}").alias(f"{n}{i}") for i in range(self.dims) for n, f in (("_low", F.min), ("_high", F.max))]
        return at.groupBy("_node", *keys).agg(F.count(F.lit(1)).alias("_n"), *box)

    def _sides(self) -> list[Column]:
        return [F.col(f"_high{i}") - F.col(f"_low{i}") for i in range(self.dims)]

    def _crowded(self) -> Column:
        return (F.col("_n") > self.leaf_size) & (F.greatest(*self._sides()) > 0)

    def _split(self, at: DataFrame, crowded: DataFrame) -> DataFrame:
        """Candidates of the crowded nodes with their child: 2 i for the values between two quantiles, odd for a quantile's own."""
        sides, value = self._sides(), F.col("_c0")
        longest = F.greatest(*sides)
        axis = F.lit(0)
        for i in reversed(range(self.dims)):
            axis = F.when(sides[i] == longest, i).otherwise(axis)
        for i in range(1, self.dims):
            value = F.when(F.col("_axis") == i, F.col(f"_c{i}")).otherwise(value)
        inside = at.join(crowded.select("_node", axis.alias("_axis")), "_node").withColumn("_value", value)
        shares = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
        cuts = inside.groupBy("_node").agg(F.array_distinct(F.percentile_approx("_value", shares, 1000)).alias("_cuts"))
        below = F.size(F.filter("_cuts", lambda c: c < F.col("_value"))) + F.size(F.filter("_cuts", lambda c: c <= F.col("_value")))
        return inside.join(materialise(cuts, "knn-cuts"), "_node").withColumn(
            "_node", F.concat("_node", F.lit("/"), below.cast("string"))).drop("_axis", "_value", "_cuts")

    def walk(self, spots: DataFrame, k: int) -> DataFrame:
        """(qx, qy, _q0.., _node, _bound): the leaves that may hold one of the k nearest candidates of a spot, and
        the square of a distance within which these are (null where there are fewer)."""
        dims = range(self.dims)
        stats = ["_n", *[f"{n}{i}" for i in dims for n in ("_low", "_high")]]
        groups = Tree(spots.withColumns({"x": F.col("qx"), "y": F.col("qy")}), self.radius, self.metric, self.leaf_size)
        placed = materialise(groups.leaves.select(
            "qx", "qy", *[F.col(f"_c{i}").alias(f"_q{i}") for i in dims], F.col("_node").alias("_group")), "knn-queries")
        box = [f(f"_q{i}").alias(f"{n}{i}") for i in dims for n, f in (("_qlow", F.min), ("_qhigh", F.max))]
        at = placed.groupBy("_group").agg(*box)
        group = ["_group", *[f"{n}{i}" for i in dims for n in ("_qlow", "_qhigh")]]
        if self.around:
            for i in dims:
                at = at.withColumn(f"_s{i}", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
            here = [F.col(f"_qlow{i}") for i in dims], [F.col(f"_s{i}") for i in dims]  # a group is in one cell
            front = at.withColumn("_node", self._cell(*here)).join(self.levels[0], "_node")
        else:
            root = self.levels[0].first()  # one node
            if root is None:
                return placed.filter("false").withColumns({"_node": F.lit(""), "_bound": F.lit(0.0)}).drop("_group")
            front = at.withColumns({n: F.lit(root[n]) for n in ("_node", *stats)})
        corners = [(F.col(f"_qlow{i}"), F.col(f"_qhigh{i}")) for i in dims]
        front = self._near(front.select(*group, "_node", *stats), ["_group"], corners, k).drop("_bound")
        for level in self.levels[1:]:
            below = level.select(F.col("_parent").alias("_above"), *[F.col(n).alias(f"_b{n}") for n in ("_node", *stats)])
            # a split node is replaced by its children, a leaf has none and stays
            front = front.join(below, F.col("_node") == F.col("_above"), "left").select(
                *group, *[F.coalesce(f"_b{n}", n).alias(n) for n in ("_node", *stats)])
            front = self._near(front, ["_group"], corners, k).drop("_bound")
        places = [f"_q{i}" for i in dims]
        met = placed.join(materialise(front.select("_group", "_node", *stats), "knn-front"), "_group").drop("_group")
        return self._near(met, ["qx", "qy"], [(F.col(q), F.col(q)) for q in places], k).select("qx", "qy", *places, "_node", "_bound")

    def _near(self, front: DataFrame, keys: Sequence[str], corners: Sequence[tuple[Column, Column]], k: int) -> DataFrame:
        """Without the nodes that cannot hold one of the k nearest candidates of a place between ``corners``; with ``_bound``."""
        near, far = F.lit(0.0), F.lit(0.0)
        for i, (first, last) in enumerate(corners):
            low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
            near = near + square(F.greatest(low - last, first - high, F.lit(0.0)))
            far = far + square(F.greatest(last - low, high - first))
        rows = front.withColumns({"_near": near, "_far": far})
        if self.reach is not None:
            rows = rows.filter(F.col("_near") <= self.reach * self.reach)
        spot = Window.partitionBy(*keys)
        by_far = spot.orderBy("_far", "_node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_sum", F.sum("_n").over(by_far)).withColumn(
            "_enough", F.min(F.when(F.col("_sum") >= k, F.col("_far"))).over(spot)
        )
        spare = slack(self.metric)
        bound = F.col("_enough") if not spare else square(F.sqrt("_enough") + spare)
        rows = rows.withColumn("_bound", bound)
        return rows.filter(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound"))).drop("_near", "_far", "_sum", "_enough")

    def between(self) -> Column:
        """Square of the straight distance of a query at _q0.. and a candidate at _c0.."""
        total = square(F.col("_c0") - F.col("_q0"))
        for i in range(1, self.dims):
            total = total + square(F.col(f"_c{i}") - F.col(f"_q{i}"))
        return total


def _compare(
    tree: Tree, leaves: DataFrame, cand_cols: Sequence[str], ties: Sequence[Column], k: int, radius: float | None
) -> DataFrame:
    pairs = leaves.join(tree.leaves.drop("x", "y"), "_node").withColumn("_between", tree.between()).filter(
        F.col("_bound").isNull() | (F.col("_between") <= F.col("_bound"))
    ).withColumn("distance", distance(tree.metric, F.col("_between")))
    if radius is not None:
        pairs = pairs.filter(F.col("distance") <= radius)
    spot = Window.partitionBy("qx", "qy").orderBy(asc("distance"), *ties)
    return (
        pairs.withColumn("_rank", F.row_number().over(spot))
        .filter(F.col("_rank") <= k)
        .select("qx", "qy", *cand_cols, "distance")
    )
