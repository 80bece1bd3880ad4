"""Contacts: trips past a panel, as weighted contacts of respondents with faces."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.bands import band_join, cut_points, deal, meet_bands
from sightline.operators.skew import Salts, heavy_keys, salted_join
from sightline.params import ReleaseParams
from sightline.session import materialise

VECTOR_COLUMNS = {"week_day_type": "weekdaytype", "week_day_name": "weekdayname"}


def frequency_bands(t, p: ReleaseParams) -> DataFrame:
    """Trips with the bands of the frequency vector they fall in."""
    trips = t.trip_routes.select("sid", "respondent_id", "routingmode", "week_day_name", "week_day_type", "trip_freq")
    on = [(k, VECTOR_COLUMNS[k]) for k in p.vector_key]
    return band_join(trips, t.freq_trips_vector, on, "trip_freq", "freq_from", "freq_to")


class Trips:
    """Trips with their respondent's weight, and the contacts they make.

    A trip can fall in several bands of the frequency vector. So ``rows`` has one row per trip,
    which joins carry, and ``contacts`` comes after them. The rows are written once, as
    statistics and results both use them.
    """

    def __init__(self, t, p: ReleaseParams) -> None:
        self.t, self.p = t, p
        day = F.col("week_day_name")
        if p.weekday_prefix is not None:
            day = F.left(day, F.lit(p.weekday_prefix))
        keys = [F.col(k).alias(f"_{k}") for k in p.vector_key] if p.use_frequency_vector else []
        value = [F.col("trip_freq").alias("_freq")] if p.use_frequency_vector else []
        weights = t.resp_weight_input.select("respondent_id", "benchwgt_pp")
        rows = materialise(t.trip_routes.join(weights, "respondent_id").select(
            "sid", "respondent_id", F.col("routingmode").alias("modality"), day.alias("dayofweek"),
            F.col("benchwgt_pp").alias("respweight"), *keys, *value,
        ), "trips")
        if p.use_frequency_vector:
            self._cuts = cut_points(rows, "_freq")
            rows = deal(rows, "_freq", self._cuts)
        self.rows = rows

    def contacts(self, joined: DataFrame) -> DataFrame:
        """Rows made from ``rows``: one per band, with their contacts ``ts_rots``."""
        if not self.p.use_frequency_vector:
            return joined.withColumn("ts_rots", F.col("respweight"))
        own = [n for n in joined.columns if n not in ("_freq", "_interval", *[f"_{k}" for k in self.p.vector_key])]
        on = [(f"_{k}", VECTOR_COLUMNS[k]) for k in self.p.vector_key]
        # named apart from the columns that may have come in
        bands = self.t.freq_trips_vector.select(
            *[F.col(n).alias(f"_band_{n}") for n in (*[b for _, b in on], "freq_from", "freq_to", "prob")])
        met = meet_bands(joined, bands, [(a, f"_band_{b}") for a, b in on], "_freq", "_band_freq_from", "_band_freq_to", self._cuts)
        return met.select(*own, (F.col("respweight") * F.col("_band_prob")).alias("ts_rots"))


def trip_contacts(t, p: ReleaseParams) -> DataFrame:
    """One row per trip and band: the respondent, their weight and contacts."""
    trips = Trips(t, p)
    return trips.contacts(trips.rows)


def panel_faces(t) -> DataFrame:
    return t.pnl_main.select("mid", "pid").join(t.pnl_facemid.select("mid", "facepid", "faceid"), "mid")


class Evidence:
    """Evidence with its heavy panel versions and trips and its run's trips, made once when first asked for.

    A version that most trips pass, or a trip that passes most panels, is dealt over
    several tasks in the joins.
    """

    def __init__(self, rows: DataFrame, least_rows: int | None = None) -> None:
        self.rows = rows.select("mid", "sid")
        self._limits = {} if least_rows is None else {"least_rows": least_rows}
        self._trips: Trips | None = None

    def trips(self, t, p: ReleaseParams) -> Trips:
        if self._trips is None or (self._trips.t, self._trips.p) != (t, p):
            self._trips = Trips(t, p)
        return self._trips

    @cached_property
    def heavy(self) -> Salts:
        return heavy_keys(self.rows, ["sid", "mid"], **self._limits)

    def with_trips(self, trips: DataFrame) -> DataFrame:
        return salted_join(self.rows, trips, "sid", self.heavy["sid"])

    def with_faces(self, met: DataFrame, faces: DataFrame) -> DataFrame:
        """Rows made from evidence with a table by panel version."""
        return salted_join(met, faces, "mid", self.heavy["mid"])


def as_evidence(evidence: DataFrame | Evidence) -> Evidence:
    return evidence if isinstance(evidence, Evidence) else Evidence(evidence)


def contact_fanout(t, p: ReleaseParams, evidence: DataFrame | Evidence) -> DataFrame:
    """Every contact of every face.

    A trip id with several rows meets evidence that already has a row for each
    of them, so it counts with the square of their number, as specified.
    """
    found = as_evidence(evidence)
    trips = found.trips(t, p)
    return trips.contacts(found.with_faces(found.with_trips(trips.rows), panel_faces(t))).select(
        "pid", "sid", "respweight", "modality", "dayofweek", "respondent_id", "ts_rots", "facepid", "faceid"
    )


def rots_per_panel_version(t, p: ReleaseParams, evidence: DataFrame | Evidence) -> DataFrame:
    """Contacts per mid, summed per trip first so the big join carries one number."""
    found = as_evidence(evidence)
    trips = found.trips(t, p)
    per_trip = trips.contacts(trips.rows).groupBy("sid").agg(F.sum("ts_rots").alias("ts_rots"))
    return found.with_trips(per_trip).groupBy("mid").agg(F.sum("ts_rots").alias("ts_rots"))


def rots_by_face(t, p: ReleaseParams, evidence: DataFrame | Evidence) -> DataFrame:
    """Contacts per (pid, faceid); every face of a panel version gets all its trips."""
    return (
        rots_per_panel_version(t, p, evidence).join(panel_faces(t), "mid")
        .groupBy("pid", "faceid").agg(F.sum("ts_rots").alias("ts_rots"))
    )


def rots_by_panel(t, p: ReleaseParams, evidence: DataFrame | Evidence) -> DataFrame:
    """Contacts per pid over all its faces."""
    faces = panel_faces(t).groupBy("mid", "pid").agg(F.count(F.lit(1)).alias("faces"))
    return (
        rots_per_panel_version(t, p, evidence).join(faces, "mid")
        .groupBy("pid").agg(F.sum(F.col("ts_rots") * F.col("faces")).alias("ts_rots"))
    )


# -- older staged form ---------------------------------------------------------
def staged_contact_input(t, p: ReleaseParams, evidence: DataFrame) -> DataFrame:
    """Evidence with trip and panel attributes."""
    trips = t.trip_routes.select("sid", "respondent_id", "routingmode")
    panels = t.pnl_main.select("mid", "pid")
    if p.numbered_panels_only:
        panels = panels.filter("pid is not null and pid <> 0")
    found = as_evidence(evidence)
    return found.with_faces(found.with_trips(trips), panels).select(
        "mid", "sid", "respondent_id", "routingmode", "pid"
    )


def staged_contacts(t, p: ReleaseParams, evidence: DataFrame) -> DataFrame:
    """Older contacts per panel: weights without a frequency vector, no faces."""
    trips = t.trip_routes.select("sid", "respondent_id", F.left("week_day_name", F.lit(p.weekday_prefix)).alias("dayofweek"))
    return (
        staged_contact_input(t, p, evidence).join(trips, ["sid", "respondent_id"])
        .join(t.resp_weight_input, "respondent_id")
        .select(
            "pid", "sid", F.col("benchwgt_pp").alias("respweight"), F.col("routingmode").alias("modality"), "dayofweek",
            "respondent_id",
        )
    )
