"""Contact / frequency statistics and the published result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.formulas import contact_frequency, half_even, ratio, reach
from sightline.operators.relational import first_per_group, update_from
from sightline.params import ReleaseParams
from sightline.plans import contacts

RESULT_COLUMNS = (
    "pid", "mid", "facepid", "faceid", "vacid", "respondent_id", "country", "weekdayname", "resp_weight", "ts_rots",
    "va", "vac", "load_id",
)
COUNTRY_PREFIX = 3


def frequency_columns(stats: DataFrame, p: ReleaseParams) -> DataFrame:
    """ts_va, ts_freq and ts_va_adj from measured contacts and ts_rots."""
    return (
        stats.withColumn("ts_va", ratio(F.col("ims_vac"), F.col("ts_rots")))
        .withColumn("ts_freq", contact_frequency(F.col("ts_va"), p.whole_frequency))
        .withColumn("ts_va_adj", ratio(F.col("ts_va"), F.col("ts_freq")))
    )


def face_stats(t, p: ReleaseParams, evidence: DataFrame, performance: DataFrame) -> DataFrame:
    """Statistics per (pid, faceid), measured values joined by face."""
    measured = first_per_group(
        performance.select("faceid_db", "vac_week_all", "rots_week_all"), ["faceid_db"], {}
    ).select(
        F.col("faceid_db").alias("faceid"), F.col("rots_week_all").alias("ims_rots"),
        F.col("vac_week_all").alias("ims_vac"),
        ratio(F.col("vac_week_all"), F.col("rots_week_all")).alias("ims_va"),
    )
    rots = contacts.rots_by_face(t, p, evidence)
    joined = update_from(rots, measured, ["faceid"], {n: n for n in ("ims_rots", "ims_vac", "ims_va")})
    return frequency_columns(joined, p)


def panel_stats(t, p: ReleaseParams, evidence: DataFrame, performance: DataFrame) -> DataFrame:
    """Statistics per pid. Of a panel's faces the lowest face id gives the measured values."""
    measured = first_per_group(
        performance.select("pid", "faceid_db", "vac_week_all", "rots_week_all"), ["pid"], {"faceid_db": "asc"}
    ).select("pid", F.col("rots_week_all").alias("ims_rots"), F.col("vac_week_all").alias("ims_vac"))
    rots = contacts.rots_by_panel(t, p, evidence)
    return frequency_columns(update_from(rots, measured, ["pid"], {n: n for n in ("ims_rots", "ims_vac")}), p)


def stats_of(t, p: ReleaseParams, evidence: DataFrame, performance: DataFrame) -> DataFrame:
    return (face_stats if p.grain == "face" else panel_stats)(t, p, evidence, performance)


def faces_with_reach(t, p: ReleaseParams, stats: DataFrame, va_digits: int | None = None) -> DataFrame:
    """Faces per mid with the va and the vac factor all their contacts share.

    va depends on the face (or panel) only, and vac is a factor times the
    contact's own weight. So statistics are joined to the faces, not to the
    contacts, and the largest table is not shuffled a second time. With ``va_digits``
    va is rounded here, once per face.
    """
    keys = ["pid", "faceid"] if p.grain == "face" else ["pid"]
    va = reach(F.col("ts_va_adj"), F.col("ts_freq"), p.frequency_cap, p.clamp)
    shared = stats.select(
        *keys,
        (va if va_digits is None else F.round(va, va_digits)).alias("va"),
        (F.col("ts_va_adj") * F.col("ts_freq")).alias("vac_factor"),
    )
    return update_from(contacts.panel_faces(t), shared, keys, {"va": "va", "vac_factor": "vac_factor"})


def contact_vac(p: ReleaseParams) -> Column:
    return F.col("vac_factor") * F.col(p.vac_weight).cast("double")


def contacts_with_reach(
    t, p: ReleaseParams, evidence: DataFrame, stats: DataFrame, va_digits: int | None = None
) -> DataFrame:
    """Contacts with va and vac."""
    found = contacts.as_evidence(evidence)
    trips = found.trips(t, p)
    faces = faces_with_reach(t, p, stats, va_digits)
    return trips.contacts(found.with_faces(found.with_trips(trips.rows), faces)).select(
        "pid", "sid", "respweight", "modality", "dayofweek", "respondent_id", "ts_rots", "facepid", "faceid", "va",
        contact_vac(p).alias("vac"),
    )


def control_sums(t, p: ReleaseParams, evidence: DataFrame, stats: DataFrame, load_id: int) -> DataFrame:
    """Sums of contacts and vac per face, for checking a load.

    All contacts of a panel version share the vac factor of a face, so their weights
    are summed per version before the faces come in.
    """
    found = contacts.as_evidence(evidence)
    trips = found.trips(t, p)
    per_trip = trips.contacts(trips.rows).groupBy("sid").agg(
        F.sum("ts_rots").alias("rots"), F.sum(p.vac_weight).alias("weight"))
    per_version = found.with_trips(per_trip).groupBy("mid").agg(
        F.sum("rots").alias("rots"), F.sum("weight").cast("double").alias("weight"))
    return per_version.join(faces_with_reach(t, p, stats), "mid").groupBy("pid", "faceid").agg(
        F.sum("rots").cast("double").alias("sum_of_ts_rots"), F.sum(F.col("vac_factor") * F.col("weight")).alias("sum_of_ts_vac"),
        F.lit(load_id).cast("bigint").alias("load_id"),
    )


def result_rows(
    t, p: ReleaseParams, evidence: DataFrame, stats: DataFrame, panels: DataFrame, load_id: int,
    va_digits: int | None = None,
) -> DataFrame:
    """Rows of a load: every contact with every listed version of its panel.

    With ``distinct_result`` equal rows count once. Equal contacts are dropped
    before they meet the listed versions; after that no two rows can be equal,
    as the listed versions are distinct too.
    """
    versions = panels.select(F.col("mid").alias("list_mid"), "pid", F.col("last_vacid").alias("vacid"))
    shared = faces_with_reach(t, p, stats, va_digits)
    found = contacts.as_evidence(evidence)
    trips = found.trips(t, p)
    met = found.with_trips(trips.rows.drop("modality"))
    if p.distinct_result:
        faces = shared.select("mid", "pid", "facepid", "faceid")
        # once per panel version first: it is the smaller row and removes most repeats
        narrow = trips.contacts(met).select("mid", "respondent_id", F.lower("dayofweek").alias("weekdayname"), "respweight", "ts_rots")
        rows = found.with_faces(narrow.distinct(), faces).drop("mid").distinct()
        by = ["pid", "faceid"] if p.grain == "face" else ["pid"]
        # joined to each other first, so the contacts meet one table keyed by panel
        panel_side = shared.select(*by, "va", "vac_factor").distinct().join(versions.distinct(), "pid")
        rows = rows.join(panel_side, by)
    else:
        named = met.withColumn("weekdayname", F.lower("dayofweek"))
        rows = trips.contacts(found.with_faces(named, shared.join(versions, "pid"))).drop("mid")
    return rows.select(
        "pid", F.col("list_mid").alias("mid"), "facepid", "faceid", "vacid", "respondent_id",
        F.left("respondent_id", F.lit(COUNTRY_PREFIX)).alias("country"), "weekdayname",
        F.col("respweight").cast("double").alias("resp_weight"), F.col("ts_rots").cast("double").alias("ts_rots"),
        "va", half_even(contact_vac(p)).alias("vac"), F.lit(load_id).cast("bigint").alias("load_id"),
    )


# -- older staged form ---------------------------------------------------------
def staged_result_rows(
    t, p: ReleaseParams, evidence: DataFrame, performance: DataFrame, load_id: int
) -> DataFrame:
    """Older result: contacts joined with the performance input by pid, face id 0."""
    rows = contacts.staged_contacts(t, p, evidence)
    rots = rows.groupBy("pid").agg(F.sum("respweight").alias("ts_rots"))
    measured = first_per_group(
        performance.select("pid", "faceid_db", "vac_week_all", "rots_week_all"), ["pid"], {"faceid_db": "asc"}
    ).select("pid", F.col("rots_week_all").alias("ims_rots"), F.col("vac_week_all").alias("ims_vac"))
    stats = frequency_columns(update_from(rots, measured, ["pid"], {n: n for n in ("ims_rots", "ims_vac")}), p)
    shared = stats.select(
        "pid", reach(F.col("ts_va_adj"), F.col("ts_freq"), p.frequency_cap, p.clamp).alias("va"),
        (F.col("ts_va_adj") * F.col("ts_freq")).alias("vac_factor"),
    )
    faces = performance.select("pid", "mid", "facepid").join(shared, "pid", "left")
    return rows.join(faces, "pid").select(
        "pid", "mid", "facepid", F.lit(0).cast("bigint").alias("faceid"), F.lit(None).cast("bigint").alias("vacid"),
        "respondent_id", F.lit(None).cast("string").alias("country"), F.lower("dayofweek").alias("weekdayname"),
        F.col("respweight").cast("double").alias("resp_weight"), F.lit(None).cast("double").alias("ts_rots"), "va",
        half_even(contact_vac(p)).alias("vac"), F.lit(load_id).cast("bigint").alias("load_id"),
    )
