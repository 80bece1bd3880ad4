"""Daily state: panels without results, their recalculation, and map versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.functions.formulas import complexity, difficulty
from sightline.operators.relational import (
    delete_where, exclude, first_per_group, first_per_key, is_in, not_in, per_listed_key, update_from,
)
from sightline.params import ReleaseParams
from sightline.plans.panels import attach_latest_result, not_calculated, panels_of
from sightline.session import materialise

NO_CALC_COLUMNS = (
    "pid", "mid", "err_vac_res", "complexity_index", "routing_difficulty", "in_queue", "calculated", "processed",
    "ignore",
)
REVISE_COLUMNS = (
    "pid", "mid", "err_vac_res", "complexity_index", "routing_difficulty", "load_id", "va", "vac", "null_zero_result",
)
QUEUE_COLUMNS = (
    "vacid", "faceid", "mid", "usrn", "stamp_in_queue", "stamp_end", "priority", "rmloadid", "temp_table",
)


def _is(flag: str, value: bool):
    return F.col(flag) == F.lit(value)


def _fill(df: DataFrame, columns, like: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(n) if n in df.columns else F.lit(None).cast(like.schema[n].dataType).alias(n) for n in columns
    ])


# -- panels without a usable result -------------------------------------------
def list_not_calculated(p: ReleaseParams, panels: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state with the new cases and current errors, panels left to work on).

    Finished entries are forgotten, ignored ones are kept for good. All listed
    pids leave the run whatever their flags; calculated ones come back later.
    """
    kept = delete_where(state, _is("processed", True) & _is("ignore", False))
    new = not_in(panels.filter(not_calculated()), kept, "pid").select("pid", "mid", "err_vac_res")
    off = F.lit(False)
    new = _fill(
        new.withColumns({"in_queue": off, "calculated": off, "processed": off, "ignore": off}), NO_CALC_COLUMNS, state
    )
    listed = kept.select(*NO_CALC_COLUMNS).unionByName(new)
    left = exclude(panels, listed, "pid")
    # the errors of the newest panel version, taken before or after the listed panels are gone
    source = panels if p.refresh_errors_first else left
    errors = first_per_group(source.select("pid", "mid", "err_vac_res"), ["pid"], {"mid": "desc"})
    return update_from(listed, errors, ["pid"], {"err_vac_res": "err_vac_res"}), left


def complexity_index(t, p: ReleaseParams, targets: DataFrame) -> DataFrame:
    """Street segments per node around each target panel, with a difficulty label.

    One segment counts per street and direction; nodes are the distinct ends of
    the segments counted.
    """
    segments = t.vai_seg
    if p.exclude_line_types:
        streets = t.topo_streets.filter(~F.col("linetype").isin(*p.exclude_line_types)).select(
            F.col("link_id").alias("navteqid"), "navteqver"
        )
        segments = segments.join(streets, ["navteqid", "navteqver"])
    def counts_per_panel(s: DataFrame) -> DataFrame:
        chosen = first_per_key(s, ["mid", "navteqid", "orient"], {})
        # every segment brings its two ends; both counts fall out of one grouping by node
        start, end = (
            F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)
        )
        ends = chosen.select("mid", F.explode(F.array(start, end)).alias("node"))
        per_node = ends.groupBy("mid", "node").agg(F.count(F.lit(1)).alias("ends"))
        return per_node.groupBy("mid").agg(
            (F.sum("ends") / 2).cast("bigint").alias("total_segments"), F.count(F.lit(1)).alias("total_nodes")
        )

    six = {n: F.round(F.col(n).cast("decimal(18,9)"), 6) for n in ("x1", "y1", "x2", "y2")}
    rounded = segments.select("mid", "navteqid", "orient", *[v.alias(n) for n, v in six.items()])
    counts = per_listed_key(rounded, targets, "mid", counts_per_panel)
    index = complexity(F.col("total_segments"), F.col("total_nodes"))
    return (
        targets.select("pid", "mid").distinct().join(counts, "mid")
        .withColumn("complexity_index", index)
        .withColumn("routing_difficulty", difficulty(F.col("complexity_index")))
        .select("pid", "mid", "total_segments", "total_nodes", "complexity_index", "routing_difficulty")
    )


def rate_complexity(t, p: ReleaseParams, state: DataFrame) -> DataFrame:
    """State with the complexity of the panels not queued yet; the newest version's where a pid has several."""
    rated = complexity_index(t, p, state.filter(_is("in_queue", False)).select("pid", "mid"))
    newest = first_per_group(
        rated.select("pid", "mid", "complexity_index", "routing_difficulty"), ["pid"], {"mid": "desc"}
    )
    return update_from(state, newest, ["pid"], {n: n for n in ("complexity_index", "routing_difficulty")})


def set_aside_errors(state: DataFrame, revise: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state without failed panels, revise list with them).

    A failed panel that is ignored leaves the state without being listed.
    """
    failed = _is("in_queue", False) & F.col("err_vac_res").isNotNull()
    new = not_in(state.filter(failed & _is("ignore", False)), revise, "pid").select(
        "pid", "mid", "err_vac_res", "complexity_index", "routing_difficulty"
    )
    revised = revise.select(*REVISE_COLUMNS).unionByName(_fill(new, REVISE_COLUMNS, revise))
    return delete_where(state, failed), revised


# -- recalculation -------------------------------------------------------------
def work_list(t, p: ReleaseParams, state: DataFrame, queued_at) -> DataFrame:
    """Queue rows for panels to recalculate: the newest version, its lowest face."""
    waiting = state.filter(_is("in_queue", False) & _is("ignore", False) & F.col("err_vac_res").isNull())
    faces = (
        is_in(t.pnl_main.select("pid", "mid"), waiting, "pid").join(t.pnl_facemid.select("mid", "faceid"), "mid")
    )
    return first_per_group(faces, ["pid"], {"mid": "desc"}).select(
        F.lit(c.QUEUE_VACID).cast("bigint").alias("vacid"), "faceid", "mid", F.lit(c.QUEUE_USER).alias("usrn"),
        F.lit(queued_at).cast("timestamp").alias("stamp_in_queue"), F.lit(None).cast("timestamp").alias("stamp_end"),
        F.lit(c.QUEUE_PRIORITY).alias("priority"), F.lit(c.QUEUE_LOAD).alias("rmloadid"),
        F.lit(p.queue_tag).alias("temp_table"),
    )


def flag_queued_and_calculated(t, p: ReleaseParams, state: DataFrame, queue: DataFrame) -> DataFrame:
    """All entries become queued; those with a finished queue entry become calculated."""
    finished = queue.filter(
        (F.col("usrn") == c.QUEUE_USER) & (F.col("temp_table") == p.queue_tag) & F.col("stamp_end").isNotNull()
        & (F.col("stamp_in_queue") > F.date_sub(F.lit(p.as_of), p.queue_days))
    )
    may_finish = state.filter(F.col("err_vac_res").isNull() & _is("ignore", False) & _is("processed", False))
    pids = is_in(is_in(t.pnl_main.select("mid", "pid"), finished, "mid"), may_finish, "pid").select("pid").distinct()
    queued = state.withColumn("in_queue", F.when(_is("in_queue", False), True).otherwise(F.col("in_queue")))
    return update_from(queued, pids.withColumn("done", F.lit(True)), ["pid"], {"calculated": "done"})


def recalculated(state: DataFrame) -> DataFrame:
    return state.filter(
        _is("in_queue", True) & _is("calculated", True) & _is("processed", False) & _is("ignore", False)
    ).select("pid")


def mark_processed(state: DataFrame) -> DataFrame:
    done = _is("calculated", True) & _is("processed", False) & _is("ignore", False)
    return state.withColumn("processed", F.when(done, True).otherwise(F.col("processed")))


@dataclass
class Recalculation:
    """What the recalculation steps of a day produce."""

    panels: DataFrame
    state: DataFrame
    revise: DataFrame
    new_queue_rows: DataFrame


def recalculation_steps(
    t, p: ReleaseParams, panels: DataFrame, queued_at, latest: DataFrame | None = None
) -> Recalculation:
    """From the changed panels (with results attached) to the list to process.

    The order matters: cases are listed, rated, failed ones set aside, the rest
    queued, and only then are calculated ones put back on the list.
    """
    state, _ = list_not_calculated(p, panels, t.no_calc_inc)
    state = materialise(state, "not-calculated")
    left = exclude(panels, state, "pid")
    rated = materialise(rate_complexity(t, p, state), "rated")
    state, revise = set_aside_errors(rated, t.pnl_to_revise)
    queue_rows = work_list(t, p, state, queued_at)
    state = flag_queued_and_calculated(t, p, state, t.vac_queue)
    back = materialise(exclude(panels_of(t, p, recalculated(state)), left, "pid"), "recalculated")
    listed = left.unionByName(with_results(t, p, back, latest)).distinct()
    return Recalculation(listed, mark_processed(state), revise, queue_rows)


def with_results(t, p: ReleaseParams, late: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Panels added late, with their latest result unless the older behaviour is asked for."""
    if p.late_panels_get_vac:
        return attach_latest_result(t, p, late, latest)
    return late.withColumns({
        "last_vacid": F.lit(None).cast("bigint"), "err_vac_res": F.lit(None).cast("string"),
        "vac_all_1": F.lit(None).cast("double"),
    })


# -- map versions ---------------------------------------------------------------
def split_map_versions(
    t, p: ReleaseParams, panels: DataFrame, state: DataFrame, latest: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(panels on the current map plus repaired ones, list of panels on an old map).

    A listed pid counts as repaired once any of its versions is on the current
    map; then all its versions join the run, also next to one already listed.
    """
    kept = delete_where(state, F.col("processed") == 1)
    old = t.pnl_main.filter(F.col("navteqver") != p.map_version).select("mid", "pid", "navteqver")
    new = panels.select("mid").join(old, "mid").withColumn("processed", F.lit(0))
    listed = kept.select("mid", "pid", "navteqver", "processed").unionByName(new)
    current = exclude(panels, listed, "mid")
    repaired = is_in(
        t.pnl_main.filter(F.col("navteqver") == p.map_version).select("pid"), listed, "pid"
    ).distinct().withColumn("repaired", F.lit(1))
    marked = update_from(
        listed.withColumn("_was", F.col("processed")), repaired, ["pid"], {"_was": "repaired"}
    )
    marked = marked.withColumn(
        "processed", F.when(F.col("processed") == 0, F.col("_was")).otherwise(F.col("processed"))
    ).drop("_was")
    marked = materialise(marked, "versions")
    back = materialise(panels_of(t, p, marked.filter("processed = 1")), "repaired")
    return current.unionByName(with_results(t, p, back, latest)), marked
