"""Publishing: taking panels down, checking results, replacing releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.operators.relational import (
    delete_where, drop_by_key, exclude, first_per_group, is_in, not_in, per_listed_key, replace_by_key, upsert,
)
from sightline.params import ReleaseParams
from sightline.plans.lifecycle import REVISE_COLUMNS
from sightline.plans.panels import active, owner_exception
from sightline.plans.performance import latest_run_per_face
from sightline.session import materialise

RELEASE_COLUMNS = (
    "rvloadid", "facepid", "vacid", "periodid", "transptype", "vac", "rots", "pid", "mid", "faceid",
)
POOL_SET_COLUMNS = ("x", "y", "radius", "vac_all_1", "maxdist", "intersection_type", "last_vacid")


def _yesterday(p: ReleaseParams):
    return F.date_sub(F.lit(p.as_of), 1)


def unpublish_list(t, p: ReleaseParams, panels: DataFrame) -> DataFrame:
    """Panels to take down, with the reason; one row per reason met.

    Panels that are being processed now stay published. The exempt owner's panels
    stay as well, unless they are demolished now.
    """
    state = t.panel_state
    no_mid = F.lit(None).cast("bigint").alias("mid")
    withdrawn = state.filter(
        (F.col("stamp") > _yesterday(p)) & F.col("status").isin(*c.STATUS_WITHDRAWN)
    ).select("mid", "pid", F.lit(c.UNPUBLISH_STATUS_TEXT).alias("desc_text"))

    published = t.release_publish.filter(F.col("rvloadid").isin(*p.releases)).select("pid").distinct()
    slipped = exclude(published, state.filter(active(p)), "pid")
    past = is_in(
        state.filter((F.col("timeattid") != c.NOT_DEMOLISHED) & (F.col("stamp") <= _yesterday(p))), slipped, "pid"
    ).select(no_mid, "pid", F.lit(c.UNPUBLISH_PAST_TEXT).alias("desc_text"))

    demolished = t.pnl_timeatts.filter(
        (F.col("stamp") > _yesterday(p)) & (F.col("timeattid") != c.NOT_DEMOLISHED)
    ).select(no_mid, "pid", F.lit(c.UNPUBLISH_DEMOLISHED_TEXT).alias("desc_text"))

    listed = withdrawn.unionByName(past)
    if p.owner_exception is not None:
        listed = exclude(listed, state.filter(owner_exception(p)), "pid")
    return exclude(listed.unionByName(demolished), panels, "pid")


def unpublish(p: ReleaseParams, published: DataFrame, listed: DataFrame) -> DataFrame:
    """Published rows without the listed pids; other releases are left alone."""
    return drop_by_key(published, listed, "pid", F.col("rvloadid").isin(*p.releases))


def invalid():
    va, vac = F.col("va"), F.col("vac")
    return va.isNull() | vac.isNull() | (va < 0) | (vac < 0)


def quarantine(result: DataFrame, revise: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid result rows, revise list with the panels of the others).

    ``result`` may hold several loads: a panel is known if the list had it before,
    not because another load in hand has set it aside.
    """
    known = revise.filter("load_id is not null")
    bad = result.filter(invalid()).select("pid", "mid", "load_id", "va", "vac").distinct()
    new = not_in(bad, known, "pid").withColumn("null_zero_result", F.lit(True))
    added = new.select(*[
        F.col(n) if n in new.columns else F.lit(None).cast(revise.schema[n].dataType).alias(n) for n in REVISE_COLUMNS
    ])
    return delete_where(result, invalid()), revise.select(*REVISE_COLUMNS).unionByName(added)


def refresh_pool(pool: DataFrame, panels: DataFrame) -> DataFrame:
    """Neighbour pool with the processed panels updated or added."""
    return upsert(pool, panels.drop("err_vac_res"), "mid", POOL_SET_COLUMNS)


def release_faces(t, performance: DataFrame) -> DataFrame:
    """Faces of the processed panels with their newest run and published face."""
    faces = materialise(is_in(t.pnl_facemid.select("mid", "faceid"), performance, "mid"), "release-faces")
    newest = per_listed_key(t.vai_vac_res.select("faceid", "vacid"), faces, "faceid", latest_run_per_face)
    panel_faces = t.pnl_facemid.select("faceid", "facepid", "mid").join(
        t.pnl_faces.select("facepid", "pid"), "facepid"
    )
    return newest.join(panel_faces, "faceid")


def release_rows(t, p: ReleaseParams, faces: DataFrame, releases: tuple[int, ...] | None = None) -> DataFrame:
    """New rows of the releases, from one scan of the results and one grouping.

    The first release has one row per panel face and transport type, the second one per
    panel face, transport type and period. A result row counts for each release that
    takes its period.
    """
    takes = [(p.ids_release, period, False) for period in (p.ids_period,)]
    takes += [(p.ims_release, period, True) for period in p.ims_periods]
    takes = [x for x in takes if releases is None or x[0] in releases]
    wanted = F.array(*[F.struct(F.lit(r).alias("release"), F.lit(q).alias("period"), F.lit(by).alias("by_period")) for r, q, by in takes])
    picked = t.output_round.filter(F.col("periodid").isin(*sorted({q for _, q, _ in takes}))).join(faces, "vacid")
    rows = picked.withColumn("_take", F.explode(F.filter(wanted, lambda w: w["period"] == F.col("periodid")))).select(
        "*", F.col("_take.release").alias("rvloadid"), F.when(F.col("_take.by_period"), F.col("periodid")).alias("_period")
    ).drop("_take")
    one = first_per_group(rows, ["rvloadid", "facepid", "transptype", "_period"], {"vacid": "desc", "faceid": "asc"})
    return one.select(*RELEASE_COLUMNS)


def release_ids(t, p: ReleaseParams, faces: DataFrame) -> DataFrame:
    """One row per panel face and transport type."""
    return release_rows(t, p, faces, (p.ids_release,))


def release_ims(t, p: ReleaseParams, faces: DataFrame) -> DataFrame:
    """One row per panel face, transport type and period."""
    return release_rows(t, p, faces, (p.ims_release,))


def publish(t, p: ReleaseParams, published: DataFrame, performance: DataFrame) -> DataFrame:
    """Replace the rows of the processed panels in both releases."""
    faces = materialise(release_faces(t, performance), "release-runs")
    return replace_by_key(published, performance, "pid", F.col("rvloadid").isin(*p.releases), release_rows(t, p, faces))


# -- registry and log -----------------------------------------------------------
def next_load_id(loads: DataFrame) -> DataFrame:
    return loads.agg((F.coalesce(F.max("load_id"), F.lit(0)) + 1).cast("bigint").alias("load_id"))


def processed_log(panels: DataFrame, load_id: int) -> DataFrame:
    return panels.select(
        "mid", "pid", "x", "y", "radius", F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(c.PROCESSED_TEXT).alias("desc_text"),
    )


def unpublished_log(listed: DataFrame) -> DataFrame:
    place = [F.lit(None).cast("double").alias(n) for n in ("x", "y", "radius")]
    return listed.select("mid", "pid", *place, F.lit(None).cast("bigint").alias("load_id"), "desc_text")
