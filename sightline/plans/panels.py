"""Panel lists: which panels a run works on, with their latest result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.operators.relational import exclude, first_per_key, is_in, not_in, per_listed_key, update_from
from sightline.params import ReleaseParams
from sightline.schemas import PANEL_LIST_COLUMNS
from sightline.session import materialise


def _panels(t, p: ReleaseParams) -> DataFrame:
    """Panel versions with place, buffer radius and latest state."""
    state = t.panel_state.select("mid", "stamp", "status", "timeattid", "ownid")
    return (
        t.pnl_main.select("mid", "pid", "maxdist")
        .join(t.pnl_geom.select("mid", "x", "y"), "mid")
        .join(state, "mid")
        .withColumn("radius", (F.col("maxdist") + p.buffer_margin).cast("double"))
    )


def _list(df: DataFrame) -> DataFrame:
    return df.select(*PANEL_LIST_COLUMNS)


def _since_yesterday(stamp: str, p: ReleaseParams) -> Column:
    return F.col(stamp) > F.date_sub(F.lit(p.as_of), 1)


def active(p: ReleaseParams) -> Column:
    """Standing panel; optionally one owner's panels in an earlier status too."""
    standing = (F.col("status") == c.STATUS_ACTIVE) & (F.col("timeattid") == c.NOT_DEMOLISHED)
    if p.owner_exception is None:
        return standing
    return standing | owner_exception(p)


def owner_exception(p: ReleaseParams) -> Column:
    return (
        (F.col("status") == c.STATUS_OWNER_EXCEPTION)
        & (F.col("ownid") == p.owner_exception)
        & (F.col("timeattid") == c.NOT_DEMOLISHED)
    )


def panel_list_full(t, p: ReleaseParams) -> DataFrame:
    """All standing panels and those of the inbox, without duplicates."""
    standing = (F.col("status") == c.STATUS_ACTIVE) & (F.col("timeattid") == c.NOT_DEMOLISHED)
    wanted = standing | F.col("pid").isin(t.panel_inbox.select("pid"))
    return _list(_panels(t, p).filter(wanted)).distinct()


def changed_panels(t, p: ReleaseParams) -> DataFrame:
    """Panels changed or re-opened since yesterday, and those of the inbox.

    A panel that qualifies twice is listed twice.
    """
    panels = _panels(t, p)
    changed = panels.filter(
        (_since_yesterday("stamp", p) & active(p)) | F.col("pid").isin(t.panel_inbox.select("pid"))
    )
    reopened_pids = t.pnl_timeatts.filter(_since_yesterday("stamp", p) & (F.col("timeattid") == c.NOT_DEMOLISHED))
    may_reopen = F.col("status") == c.STATUS_ACTIVE
    if p.owner_exception is not None:
        may_reopen = may_reopen | owner_exception(p)
    reopened = is_in(panels.filter(may_reopen), reopened_pids, "pid")
    return _list(changed).unionByName(_list(reopened))


def panels_of(t, p: ReleaseParams, pids: DataFrame) -> DataFrame:
    """All versions of the panels in ``pids``."""
    return _list(is_in(_panels(t, p), pids, "pid"))


def latest_runs(t, panels: DataFrame) -> DataFrame:
    """Newest visibility run of each listed panel version, with its error."""
    runs = t.vai_vac_res.select("mid", "vacid", "err_vac_res")
    return per_listed_key(runs, panels, "mid", lambda r: first_per_key(r, ["mid"], {"vacid": "desc"}))


def results_of(t, p: ReleaseParams, runs: DataFrame) -> DataFrame:
    """Runs with their value ``vac``.

    The value of a panel is the one of the newest run that has a result, and counts only
    if that run is the newest of all. This is the same as the result of the newest run, so
    results are looked up for the runs at hand instead of ranking all.
    """
    results = t.output_round.filter((F.col("periodid") == p.vac_period) & (F.col("transptype") == "ALL"))
    values = per_listed_key(
        results, runs, "vacid", lambda r: r.groupBy("vacid").agg(F.max("vac").alias("vac"))
    )
    return runs.join(values, "vacid", "left")


def latest_results(t, p: ReleaseParams) -> DataFrame:
    """Newest run of every panel version with its error and value, written once for several lists."""
    runs = first_per_key(t.vai_vac_res.select("mid", "vacid", "err_vac_res"), ["mid"], {"vacid": "desc"})
    return materialise(results_of(t, p, materialise(runs, "latest-runs")), "latest-results")


def attach_latest_result(t, p: ReleaseParams, panels: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Add last_vacid, err_vac_res and vac_all_1, looked up in ``latest_results`` where they are at hand."""
    if latest is None:
        # written, as the results are looked up by it and joined with it
        latest = results_of(t, p, materialise(latest_runs(t, panels), "latest-runs"))
    return update_from(
        panels, latest, ["mid"], {"last_vacid": "vacid", "err_vac_res": "err_vac_res", "vac_all_1": "vac"}
    )


def not_calculated() -> Column:
    vac = F.col("vac_all_1")
    return (vac == 0) | vac.isNull() | F.col("err_vac_res").isNotNull()


def split_not_calculated(panels: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list of panels without a usable result, panels left to work on).

    The list only grows: a pid once listed stays out of every later run until it
    is taken off by hand.
    """
    new = not_in(panels.filter(not_calculated()), listed, "pid").select("pid", "err_vac_res")
    listed_now = listed.select("pid", "err_vac_res").unionByName(new)
    return listed_now, exclude(panels, listed_now, "pid")


def set_intersection_type(panels: DataFrame, intersections: DataFrame) -> DataFrame:
    """ORIGINAL where a trip crosses the panel, SUBSTITUTE where none does."""
    crossed = intersections.select("mid").distinct().withColumn("intersection_type", F.lit(c.ORIGINAL))
    typed = update_from(panels, crossed, ["mid"], {"intersection_type": "intersection_type"})
    return typed.fillna({"intersection_type": c.SUBSTITUTE})


