"""The registered queries: each runs one operator over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.params import ReleaseParams, legacy_full_params, legacy_incremental_params
from sightline.plans import ccf, contacts, evidence, lifecycle, panels, performance, publish
from sightline.plans.full import FullRun
from sightline.plans.incremental import IncrementalRun
from sightline.session import materialise
from sightline.sources import driver_tables
from sightline.sources.driver_tables import AS_OF, MAP_VERSION, DriverTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _tables(build: Callable[[DriverTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(DriverTables(spark, sf_dir))


def _full(build: Callable[[FullRun], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(FullRun(DriverTables(spark, sf_dir), driver_tables.full()))


def _daily(build: Callable[[IncrementalRun], DataFrame], p: ReleaseParams | None = None) -> Query:
    return lambda spark, sf_dir: build(IncrementalRun(DriverTables(spark, sf_dir), p or driver_tables.incremental()))


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# -- performance input -----------------------------------------------------------
QUERIES["latest_vac_per_face"] = _tables(
    lambda t: performance.latest_run_per_face(t.vai_vac_res.select("faceid", "vacid", "mid", "err_vac_res"))
)
QUERIES["ims_input_base"] = _full(lambda r: performance.performance_base(r.t, r.p, r.panels))
QUERIES["ims_transport_pivot"] = _tables(
    lambda t: performance.transport_pivot(t.output_round, 1, driver_tables.full().transport_types)
)
QUERIES["ims_va_ratios"] = _full(lambda r: r.performance)

# -- panel list --------------------------------------------------------------------
QUERIES["panel_list_full"] = _full(lambda r: r.listed)
QUERIES["latest_vac_per_panel"] = _full(lambda r: panels.latest_runs(r.t, r.listed))
QUERIES["latest_vac_value"] = _full(
    lambda r: r.with_results.select("mid", "pid", "last_vacid", "err_vac_res", "vac_all_1")
)


def _no_calc_split(r: FullRun) -> DataFrame:
    listed, kept = r.no_calc_split
    return listed.select(F.lit("listed").alias("bucket"), "pid", _null("bigint").alias("mid"), "err_vac_res").unionByName(
        kept.select(F.lit("kept").alias("bucket"), "pid", "mid", "err_vac_res")
    )


def _counters(r: FullRun) -> DataFrame:
    counted = {
        "listed": r.listed, "not_calculated": r.no_calc, "to_process": r.panels,
        "performance_rows": performance.performance_base(r.t, r.p, r.panels),
    }
    rows = [df.agg(F.lit(name).alias("counter"), F.count(F.lit(1)).alias("n")) for name, df in counted.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


QUERIES["no_calc_split"] = _full(_no_calc_split)
QUERIES["next_load_id"] = _tables(lambda t: publish.next_load_id(t.loads))
QUERIES["run_counters"] = _full(_counters)

# -- trips and neighbours ------------------------------------------------------------
QUERIES["panel_trip_intersection"] = _full(lambda r: r.intersections)
QUERIES["intersection_type"] = _full(
    lambda r: r.typed_panels.select("mid", "pid", "vac_all_1", "intersection_type")
)
QUERIES["nearest20"] = _full(lambda r: r.nearest)
QUERIES["nearest20_best_match"] = _full(lambda r: r.best)
QUERIES["nearest20_unbounded"] = _full(
    lambda r: evidence.nearest_panels(r.p.with_(neighbour_radius=None), r.typed_panels, r.typed_panels).select(
        "mid_woi", "mid_near", "distance", "rank"
    )
)
QUERIES["nearest20_lonlat"] = _full(
    lambda r: evidence.nearest_panels(
        r.p.with_(metric="metres"), driver_tables.places_on_globe(r.typed_panels), driver_tables.places_on_globe(r.typed_panels)
    ).select("mid_woi", "mid_near", "distance", "rank")
)
QUERIES["intersection_lonlat"] = _full(
    lambda r: evidence.trip_intersections(
        driver_tables.lines_on_globe(r.t.trip_routes), r.p.with_(buffer_metric="metres"), driver_tables.places_on_globe(r.panels)
    )
)
QUERIES["substitute_evidence"] = _full(lambda r: r.borrowed)
QUERIES["evidence_full"] = _full(lambda r: r.evidence)

# -- contacts and formula ---------------------------------------------------------------
QUERIES["freq_band_join"] = _tables(
    lambda t: _as_double(
        contacts.frequency_bands(t, driver_tables.full()).select(
            "sid", "week_day_type", "weekdayname", "freq_from", "freq_to", "prob"
        ),
        "prob",
    )
)
QUERIES["contact_fanout_full"] = _full(lambda r: _as_double(r.contacts, "respweight", "ts_rots"))
QUERIES["contact_fanout_inc"] = _daily(lambda r: _as_double(r.contacts, "respweight", "ts_rots"))
QUERIES["rots_by_face"] = _full(lambda r: _as_double(contacts.rots_by_face(r.t, r.p, r.weighed), "ts_rots"))
QUERIES["rots_by_panel"] = _daily(lambda r: _as_double(contacts.rots_by_panel(r.t, r.p, r.weighed), "ts_rots"))
QUERIES["ccf_face_stats"] = _full(lambda r: _as_double(r.stats, "ts_rots"))
QUERIES["ccf_panel_stats"] = _daily(lambda r: _as_double(r.stats, "ts_rots"))


def _contacts_with_reach(r: FullRun | IncrementalRun) -> DataFrame:
    found = ccf.contacts_with_reach(r.t, r.p, r.weighed, r.stats, va_digits=6)
    return _rounded(_as_double(found, "respweight", "ts_rots"), "vac")


def _result(r: FullRun | IncrementalRun) -> DataFrame:
    return ccf.result_rows(r.t, r.p, r.weighed, r.stats, r.panels, r.load_id, va_digits=6)


QUERIES["ccf_full"] = _full(_contacts_with_reach)
QUERIES["ccf_inc"] = _daily(_contacts_with_reach)
QUERIES["control_sum"] = _full(lambda r: _rounded(r.control_sums, "sum_of_ts_vac"))
QUERIES["ccf_result_full"] = _full(_result)
QUERIES["ccf_result_inc"] = _daily(_result)

# -- daily state ---------------------------------------------------------------------------
QUERIES["panel_list_inc"] = _daily(lambda r: r.changed)
QUERIES["panels_to_process"] = _daily(lambda r: r.to_process)
QUERIES["complexity_index"] = _tables(
    lambda t: _as_double(
        lifecycle.complexity_index(t, driver_tables.incremental(), t.pnl_main.select("pid", "mid")), "complexity_index"
    )
)
QUERIES["complexity_index_linetype"] = _tables(
    lambda t: _as_double(
        lifecycle.complexity_index(
            t, legacy_incremental_params(AS_OF, MAP_VERSION), t.pnl_main.select("pid", "mid")
        ).drop("routing_difficulty"),
        "complexity_index",
    )
)


def _revise_split(r: IncrementalRun) -> DataFrame:
    state, _ = lifecycle.list_not_calculated(r.p, r.with_results, r.t.no_calc_inc)
    state, revise = lifecycle.set_aside_errors(lifecycle.rate_complexity(r.t, r.p, state), r.t.pnl_to_revise)
    names = ["pid", "mid", "err_vac_res", "complexity_index", "routing_difficulty", "load_id"]
    both = state.withColumn("load_id", _null("bigint")).select(F.lit("open").alias("bucket"), *names).unionByName(
        revise.select(F.lit("revise").alias("bucket"), *names)
    )
    return _as_double(both, "complexity_index")


def _version_split(r: IncrementalRun) -> DataFrame:
    current, listed = r.version_split
    return listed.select(F.lit("listed").alias("bucket"), "mid", "pid", "navteqver", "processed").unionByName(
        current.select(
            F.lit("panel").alias("bucket"), "mid", "pid", _null("string").alias("navteqver"),
            _null("int").alias("processed"),
        )
    )


def _quarantine(r: IncrementalRun) -> DataFrame:
    valid, revise = publish.quarantine(_rounded(r.result, "va"), r.recalculation.revise)
    names = ["pid", "mid", "faceid", "respondent_id", "weekdayname", "va", "vac", "load_id"]
    listed = revise.withColumns(
        {"faceid": _null("bigint"), "respondent_id": _null("string"), "weekdayname": _null("string")}
    )
    return valid.select(F.lit("valid").alias("bucket"), *names).unionByName(
        listed.select(F.lit("revise").alias("bucket"), *names)
    )


QUERIES["revise_split"] = _daily(_revise_split)
QUERIES["recalc_worklist"] = _daily(
    lambda r: r.recalculation.new_queue_rows.drop("stamp_in_queue", "stamp_end")
)
QUERIES["recalc_state_step"] = _daily(lambda r: _as_double(r.recalculation.state, "complexity_index"))
QUERIES["bad_version_split"] = _daily(_version_split)
QUERIES["unpublish_list"] = _daily(lambda r: r.unpublish_list)
QUERIES["unpublish_apply"] = _daily(lambda r: r.after_unpublish)
QUERIES["substitute_intersection"] = _daily(lambda r: r.substitute_intersections.select("mid", "sid"))
QUERIES["upsert_panel_pool"] = _daily(lambda r: r.pool.drop("err_vac_res"))
QUERIES["quarantine_invalid"] = _daily(_quarantine)
QUERIES["publish_ids"] = _daily(lambda r: publish.release_ids(r.t, r.p, publish.release_faces(r.t, r.performance)))
QUERIES["publish_ims"] = _daily(lambda r: publish.release_ims(r.t, r.p, publish.release_faces(r.t, r.performance)))
QUERIES["publish_replace"] = _daily(lambda r: r.published)
QUERIES["panel_audit_log"] = _daily(
    lambda r: publish.processed_log(r.panels, r.load_id).unionByName(publish.unpublished_log(r.unpublish_list))
)

# -- older forms -----------------------------------------------------------------------------
# The test tables have releases 100 and 101 only, so the owner exception is run on those.
_OWNER = driver_tables.incremental().with_(owner_exception=51)
_LEGACY_FULL = legacy_full_params(AS_OF, MAP_VERSION)

QUERIES["panel_list_owner_exception"] = _tables(lambda t: panels.changed_panels(t, _OWNER))
QUERIES["unpublish_list_owner_exception"] = _tables(
    lambda t: publish.unpublish_list(t, _OWNER, panels.changed_panels(t, _OWNER))
)
QUERIES["ims_weekly_scale"] = _full(
    lambda r: performance.performance_input(r.t, _LEGACY_FULL, r.panels).drop("pnlvaienv")
)
QUERIES["ccf_input_legacy"] = _full(lambda r: contacts.staged_contact_input(r.t, _LEGACY_FULL, r.weighed))
QUERIES["ccf_result_legacy"] = _full(
    lambda r: _rounded(
        ccf.staged_result_rows(
            r.t, _LEGACY_FULL, r.weighed,
            materialise(performance.performance_input(r.t, _LEGACY_FULL, r.panels), "legacy-performance"), r.load_id,
        ).drop("vacid", "country", "ts_rots", "load_id"),
        "va",
    )
)

# the older daily run: periods 2, 10 and 11, releases 104 and 105, the owner exception, trips of an earlier survey
_LEGACY_DAILY = legacy_incremental_params(AS_OF, MAP_VERSION)
QUERIES["panels_to_process_legacy"] = _daily(lambda r: r.to_process, _LEGACY_DAILY)
QUERIES["substitute_intersection_legacy"] = _daily(lambda r: r.substitute_intersections.select("mid", "sid"), _LEGACY_DAILY)
QUERIES["ccf_result_inc_legacy"] = _daily(
    lambda r: _rounded(r.result.drop("vacid", "country", "ts_rots", "load_id"), "va"), _LEGACY_DAILY
)
QUERIES["publish_replace_legacy"] = _daily(lambda r: r.published, _LEGACY_DAILY)

# two steps in their older order
QUERIES["recalc_state_errors_last"] = _daily(
    lambda r: _as_double(r.recalculation.state, "complexity_index"), driver_tables.incremental().with_(refresh_errors_first=False)
)
QUERIES["panels_late_without_vac"] = _daily(
    lambda r: r.panels.select("mid", "pid", "last_vacid", "err_vac_res", "vac_all_1"),
    driver_tables.incremental().with_(late_panels_get_vac=False),
)
