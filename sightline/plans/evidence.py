"""Evidence: which trips count for which panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.operators.neighbours import knn_join
from sightline.operators.relational import asc
from sightline.operators.spatial import within_distance_join
from sightline.params import ReleaseParams

EVIDENCE_COLUMNS = ("mid", "sid", "week_day_name", "week_day_type")


def trip_intersections(trips: DataFrame, p: ReleaseParams, panels: DataFrame, panel_key: str = "mid") -> DataFrame:
    """Trips that pass within the buffer radius of each panel row."""
    # several rows of one trip id are told apart by their row key, if there is one
    key = ["sid", "trip_row"] if "trip_row" in trips.columns else ["sid"]
    found = within_distance_join(
        panels, trips, point_cols=[panel_key], line_key=key, line_cols=["week_day_name", "week_day_type"],
        metric=p.buffer_metric,
    )
    return found.select(F.col(panel_key).alias("mid"), "sid", "week_day_name", "week_day_type")


def nearest_panels(p: ReleaseParams, panels: DataFrame, pool: DataFrame) -> DataFrame:
    """The nearest crossed panels of the pool for every panel no trip crosses."""
    without = panels.filter(F.col("intersection_type") == c.SUBSTITUTE).select(
        F.col("mid").alias("mid_woi"), F.col("vac_all_1").alias("vac_woi"), "x", "y"
    )
    crossed = pool.filter(F.col("intersection_type") == c.ORIGINAL).select(
        F.col("mid").alias("mid_near"), F.col("vac_all_1").alias("vac_near"), F.col("pid").alias("pid_near"), "x", "y"
    )
    near = knn_join(
        without, crossed, k=p.neighbour_count, query_key="mid_woi", candidate_key="mid_near",
        radius=p.neighbour_radius, metric=p.metric, exclude_self=p.exclude_self,
    )
    return near.select("mid_woi", "vac_woi", "mid_near", "vac_near", "pid_near", "distance", "rank")


def best_neighbour(nearest: DataFrame) -> DataFrame:
    """Of the nearest panels the one with the closest value, then the nearer."""
    gap = F.abs(F.col("vac_woi") - F.col("vac_near"))
    w = Window.partitionBy("mid_woi").orderBy(asc("value_difference"), asc("distance"), asc("mid_near"))
    return (
        nearest.withColumn("value_difference", gap)
        .withColumn("_rank", F.row_number().over(w))
        .filter("_rank = 1")
        .select(
            "mid_woi", "vac_woi", F.col("mid_near").alias("best_mid_near"), F.col("vac_near").alias("best_vac_near"),
            F.col("distance").alias("geometric_distance"), "value_difference",
            F.col("pid_near").alias("best_pid_near"),
        )
    )


def borrowed_evidence(best: DataFrame, intersections: DataFrame) -> DataFrame:
    """The trips of the chosen neighbour, for the panel that has none."""
    chosen = best.select("mid_woi", F.col("best_mid_near").alias("mid"))
    return intersections.join(chosen, "mid").select(
        F.col("mid_woi").alias("mid"), "sid", "week_day_name", "week_day_type"
    )


def substitute_intersections(t, p: ReleaseParams, best: DataFrame) -> DataFrame:
    """Trips crossing the buffer of the chosen neighbour, under the own panel's id.

    Used where the neighbour comes from an earlier run, so its trips are not at
    hand. The rows carry no weekday.
    """
    shapes = t.pnl_main.select(F.col("mid").alias("best_mid_near"), "maxdist").join(
        t.pnl_geom.select(F.col("mid").alias("best_mid_near"), "x", "y"), "best_mid_near"
    )
    borrowed = best.select("mid_woi", "best_mid_near").join(shapes, "best_mid_near").select(
        "mid_woi", "x", "y", (F.col("maxdist") + p.buffer_margin).cast("double").alias("radius")
    )
    found = trip_intersections(getattr(t, p.substitute_trips), p, borrowed, panel_key="mid_woi")
    none = F.lit(None).cast("string")
    return found.select("mid", "sid", none.alias("week_day_name"), none.alias("week_day_type"))
