"""State steps of the daily run."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF, LONG_AGO, NOON_TODAY, NOON_YESTERDAY, rows
from pyspark.sql import functions as F

from sightline.params import legacy_incremental_params
from sightline.plans import evidence, lifecycle, panels, performance, publish
from sightline.sources.driver_tables import DriverTables

FLAGS = ("in_queue", "calculated", "processed", "ignore")


def entry(pid, err=None, in_queue=False, calculated=False, processed=False, ignore=False, mid=None):
    return (pid, mid or pid, err, None, None, in_queue, calculated, processed, ignore)


def listed(spark, *rows_):
    return spark.createDataFrame(
        list(rows_),
        "mid BIGINT, pid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE, maxdist INT, last_vacid BIGINT, err_vac_res STRING,"
        " vac_all_1 DOUBLE",
    )


def panel(mid, vac, err=None, pid=None):
    return (mid, pid or mid, 0.0, 0.0, 300.0, 100, 1, err, vac)


def test_changed_since_yesterday(tables, daily_p):
    t = tables(
        pnl_main=[(m, m, 10, "K", "S", "25q1") for m in range(1, 8)],
        pnl_geom=[(m, 0.0, 0.0) for m in range(1, 8)],
        panel_state=[
            (1, 1, NOON_TODAY, 3, 0, 7),
            (2, 2, NOON_YESTERDAY, 3, 0, 7),  # later than the start of yesterday
            (3, 3, dt.datetime(2024, 5, 9), 3, 0, 7),  # exactly the start of yesterday
            (4, 4, NOON_TODAY, 1, 0, 51),
            (5, 5, LONG_AGO, 3, 1, 7),  # re-opened
            (6, 6, LONG_AGO, 2, 0, 7),  # inbox
            (7, 7, LONG_AGO, 3, 0, 7),
        ],
        pnl_timeatts=[(5, NOON_TODAY, 0), (1, NOON_TODAY, 0), (7, NOON_TODAY, 1)],
        panel_inbox=[(6,)],
    )
    assert rows(panels.changed_panels(t, daily_p), "mid") == [(1,), (1,), (2,), (5,), (6,)]
    assert rows(panels.changed_panels(t, daily_p.with_(owner_exception=51)), "mid") == [
        (1,), (1,), (2,), (4,), (5,), (6,)
    ]


def test_latest_result_counts_only_if_it_is_the_latest_run(tables, spark, full_p):
    t = tables(
        vai_vac_res=[(1, 10, 1, None), (2, 10, 1, "E"), (3, 20, 2, None), (4, 30, 3, None)],
        output_round=[(1, 1, "ALL", 5.0, 1.0), (3, 1, "ALL", 6.0, 1.0), (3, 1, "VEH", 9.0, 1.0), (4, 2, "ALL", 7.0, 1.0)],
    )
    base = spark.createDataFrame([(10,), (20,), (30,), (40,)], "mid BIGINT")
    got = panels.attach_latest_result(t, full_p, base)
    assert rows(got, "mid", "last_vacid", "err_vac_res", "vac_all_1") == [
        (10, 2, "E", None), (20, 3, None, 6.0), (30, 4, None, None), (40, None, None, None)
    ]
    assert rows(panels.attach_latest_result(t, full_p.with_(vac_period=2), base), "vac_all_1") == [
        (None,), (None,), (None,), (7.0,)
    ]


def test_lists_of_a_daily_run_share_the_latest_results(tables, spark, daily_p, monkeypatch):
    """Runs and results are read once for the changed, the recalculated and the repaired panels."""
    from sightline.plans.incremental import IncrementalRun

    t = tables(
        pnl_main=[(m, m, 100, "K", "S", "24q4" if m == 5 else "25q1") for m in range(1, 8)],
        pnl_geom=[(m, 10.0 * m, 0.0) for m in range(1, 8)],
        panel_state=[(m, m, NOON_TODAY if m < 4 else LONG_AGO, 3, 0, 7) for m in range(1, 8)],
        vai_vac_res=[(100 + m, m, m, None) for m in range(1, 8)] + [(1, m, m, "E") for m in range(1, 8)],
        output_round=[(100 + m, 1, "ALL", float(m), 1.0) for m in range(1, 8)],
        no_calc_inc=[entry(4, in_queue=True, calculated=True)],
        bad_navteq=[(6, 6, "24q4", 0)],
    )
    written = []
    for module in (panels, lifecycle):
        write = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, label, _write=write, **kw: written.append(label) or _write(df, label, **kw))
    run = IncrementalRun(t, daily_p)
    assert rows(run.panels, "mid", "last_vacid", "err_vac_res", "vac_all_1") == [
        (m, 100 + m, None, float(m)) for m in (1, 2, 3, 4, 6)]
    assert written.count("latest-runs") == written.count("latest-results") == 1


def test_statistics_and_results_share_the_trips(tables, spark, full_p, monkeypatch):
    """The trips are joined with their weights once, and a trip is one row until its bands are met."""
    from sightline.plans import ccf, contacts

    line = [(0.0, 0.0), (1.0, 0.0)]
    bands = [("WD", day, lo, 50.0, Decimal(prob)) for day in ("Monday", "Friday") for lo, prob in ((0.0, "0.5"), (9.0, "1.0"))]
    t = tables(
        pnl_main=[(1, 1, 100, "K", "S", "25q1"), (2, 2, 100, "K", "S", "25q1")],
        pnl_facemid=[(1, 11, 11, "F11"), (1, 12, 12, "F12"), (2, 21, 21, "F21")],
        trip_routes=[(1, "CZE1", "car", "Monday", "WD", 10.0, line), (2, "CZE2", "bus", "Friday", "WD", 5.0, line),
                     (3, "CZE2", "car", "Monday", "WD", None, line), (4, "CZE9", "car", "Monday", "WD", 10.0, line)],
        resp_weight_input=[("CZE1", Decimal("2.000")), ("CZE2", Decimal("3.000"))],
        freq_trips_vector=bands,
    )
    written, write = [], contacts.materialise
    monkeypatch.setattr(contacts, "materialise", lambda df, label: written.append(label) or write(df, label))
    found = contacts.Evidence(spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3), (2, 4)], "mid BIGINT, sid BIGINT"))
    measured = spark.createDataFrame([(11, 2.0, 20.0), (12, 7.0, 9.0)], "faceid_db BIGINT, vac_week_all DOUBLE, rots_week_all DOUBLE")
    stats = ccf.face_stats(t, full_p, found, measured)
    # trip 1: twice half and twice all of 2.0; trip 2: twice half of 3.0
    assert rows(stats, "faceid", "ts_rots") == [(11, Decimal("9.0")), (12, Decimal("9.0")), (21, Decimal("6.0"))]
    exact = ccf.contacts_with_reach(t, full_p, found, stats)
    assert rows(exact.filter("faceid = 11"), "sid", "dayofweek", "respweight", "ts_rots") == [
        (1, "Monday", Decimal("2.0"), Decimal(r)) for r in ("1.0", "1.0", "2.0", "2.0")
    ] + [(2, "Friday", Decimal("3.0"), Decimal("1.5"))] * 2
    assert found.trips(t, full_p).rows.count() == 2 and written == ["trips"]
    rounded = ccf.contacts_with_reach(t, full_p, found, stats, va_digits=3)
    names = ("faceid", "sid", "ts_rots", "va", "vac")
    assert rows(rounded, *names) == rows(exact.withColumn("va", F.round("va", 3)), *names)
    assert rows(contacts.contact_fanout(t, full_p, found)) == rows(exact.drop("va", "vac")) and written == ["trips"]


def test_performance_rules(tables, spark, full_p):
    t = tables(
        pnl_main=[(1, 1, 10, "A", "D", "v"), (2, 2, 10, "B", None, "v"), (3, 3, 10, "C", "S", "v")],
        pnl_facemid=[(1, 11, 11, "x"), (1, 12, 12, "x"), (2, 21, 21, "x"), (3, 31, 31, "x"), (3, 32, 32, "x")],
        pnl_faces=[(11, 1, 1), (12, 1, 2), (21, 2, 1), (31, 3, 1), (32, 3, 2)],
        code_pnlsubtype=[("A", "EA"), ("B", "EB"), ("C", "EB")],
        vai_vac_res=[(1, 1, 11, None), (2, 1, 12, None), (3, 2, 21, None), (4, 3, 31, None), (5, 3, 31, "E"), (6, 3, 32, None)],
        output_round=[(1, 1, "ALL", 0.0, 10.0), (1, 1, "VEH", 0.0, 10.0), (5, 1, "ALL", 3.0, 12.0), (6, 1, "BIC", 3.0, 0.0)],
    )
    got = performance.performance_input(t, full_p, t.pnl_main)
    # rotating: first position only; unknown motion: none; the newest run of a face also if it failed
    assert rows(got, "faceid_db", "vacid", "pnlvaienv", "va_week_all", "va_week_veh", "va_week_bic") == [
        (11, 1, "Roadside", None, 0.0, None), (31, 5, "Indoor", 0.25, None, None), (32, 6, "Indoor", None, None, None)
    ]


def test_list_of_not_calculated(tables, spark, daily_p):
    state = [
        entry(1, processed=True), entry(2, processed=True, ignore=True), entry(3, err="old"), entry(4),
    ]
    t = tables(no_calc_inc=state)
    run = listed(
        spark, panel(1, 0.0), panel(3, 5.0), panel(5, None, "E"), panel(6, 7.0), panel(41, 5.0, pid=4), panel(42, 5.0, "E", 4)
    )
    got, left = lifecycle.list_not_calculated(daily_p, run, t.no_calc_inc)
    # 1 was finished and comes in anew; 3 lost its error; 4 takes the error of its newest version
    assert rows(got, "pid", "err_vac_res", "ignore") == [
        (1, None, False), (2, None, True), (3, None, False), (4, "E", False), (5, "E", False)
    ]
    assert rows(left, "pid") == [(6,)]
    late, _ = lifecycle.list_not_calculated(daily_p.with_(refresh_errors_first=False), run, t.no_calc_inc)
    assert rows(late.filter("pid in (3, 4)"), "pid", "err_vac_res") == [(3, "old"), (4, None)]


def test_failed_panels_are_set_aside(tables):
    t = tables(
        no_calc_inc=[entry(1, "E"), entry(2, "E", ignore=True), entry(3, "E", in_queue=True), entry(4), entry(5, "E")],
        pnl_to_revise=[(5, 5, None, None, None, 1, None, None, None)],
    )
    state, revise = lifecycle.set_aside_errors(t.no_calc_inc, t.pnl_to_revise)
    assert rows(state, "pid") == [(3,), (4,)]
    assert rows(revise, "pid", "load_id", "err_vac_res") == [(1, None, "E"), (5, 1, None)]


def test_work_list_takes_newest_version_and_lowest_face(tables, daily_p):
    t = tables(
        no_calc_inc=[entry(1), entry(2, ignore=True), entry(3, "E"), entry(4, in_queue=True)],
        pnl_main=[(m, pid, 10, "K", "S", "v") for m, pid in ((10, 1), (11, 1), (20, 2), (30, 3), (40, 4))],
        pnl_facemid=[(10, 1, 1, ""), (11, 7, 1, ""), (11, 5, 2, ""), (20, 9, 3, ""), (30, 9, 4, ""), (40, 9, 5, "")],
    )
    got = lifecycle.work_list(t, daily_p, t.no_calc_inc, NOON_TODAY)
    assert rows(got, "mid", "faceid", "vacid", "priority", "temp_table", "usrn") == [
        (11, 5, 0, 1, 50820, "init_continous_release")
    ]


def test_flags(tables, daily_p):
    t = tables(
        pnl_main=[(m, m, 10, "K", "S", "v") for m in range(1, 8)],
        no_calc_inc=[
            entry(1, in_queue=True), entry(2, in_queue=True), entry(3, in_queue=True), entry(4, ignore=True),
            entry(5, "E", in_queue=True), entry(6, in_queue=True), entry(7),
        ],
        vac_queue=[
            (0, 1, 1, "init_continous_release", NOON_YESTERDAY, NOON_TODAY, 1, 0, 50820),
            (0, 1, 2, "init_continous_release", NOON_YESTERDAY, None, 1, 0, 50820),  # not finished
            (0, 1, 3, "init_continous_release", dt.datetime(2024, 5, 6), NOON_TODAY, 1, 0, 50820),  # too old
            (0, 1, 4, "init_continous_release", NOON_YESTERDAY, NOON_TODAY, 1, 0, 50820),
            (0, 1, 5, "init_continous_release", NOON_YESTERDAY, NOON_TODAY, 1, 0, 50820),
            (0, 1, 6, "init_continous_release", NOON_YESTERDAY, NOON_TODAY, 1, 0, 50020),  # other tag
        ],
    )
    state = lifecycle.flag_queued_and_calculated(t, daily_p, t.no_calc_inc, t.vac_queue)
    # entries never queued (ignored ones) are flagged as queued all the same
    assert rows(state, "pid", "in_queue", "calculated") == [
        (1, True, True), (2, True, False), (3, True, False), (4, True, False), (5, True, False), (6, True, False),
        (7, True, False),
    ]
    assert rows(lifecycle.recalculated(state)) == [(1,)]
    assert rows(lifecycle.mark_processed(state).filter("processed"), "pid") == [(1,)]


def test_complexity(tables, daily_p):
    def seg(mid, street, orient, ends):
        return (mid, street, "v", orient, *ends)

    t = tables(vai_seg=[
        seg(1, 1, "F", (0.0, 0.0, 1.0, 0.0)), seg(1, 1, "F", (0.0, 0.0, 1.0, 0.0)), seg(1, 1, "T", (1.0, 0.0, 0.0, 0.0)),
        seg(1, 2, "F", (0.0, 0.0, 1.0000001, 0.0)), seg(2, 1, "F", (0.0, 0.0, 5.0, 5.0)), seg(9, 1, "F", (0.0, 0.0, 1.0, 1.0)),
    ], topo_streets=[(1, "v", "69"), (2, "v", "70")])
    targets = t._spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "pid BIGINT, mid BIGINT")
    got = lifecycle.complexity_index(t, daily_p, targets).withColumn("ix", F.col("complexity_index").cast("string"))
    # three segments on two nodes; ends equal to six places are one node
    assert rows(got, "mid", "total_segments", "total_nodes", "ix", "routing_difficulty") == [
        (1, 3, 2, "1.500", "MEDIUM (Standard)"), (2, 1, 2, "0.500", "LOW (Linear/Simple)")
    ]
    older = lifecycle.complexity_index(t, legacy_incremental_params(AS_OF, "v"), targets)
    assert rows(older, "mid", "total_segments") == [(1, 2), (2, 1)]


def test_map_versions(tables, spark, daily_p):
    t = tables(
        pnl_main=[(1, 1, 10, "K", "S", "24q4"), (2, 2, 10, "K", "S", "25q1"), (3, 3, 10, "K", "S", "25q1"),
                  (4, 4, 10, "K", "S", "24q4"), (5, 5, 10, "K", "S", None)],
        pnl_geom=[(m, 0.0, 0.0) for m in range(1, 6)],
        panel_state=[(m, m, LONG_AGO, 3, 0, 7) for m in range(1, 6)],
        bad_navteq=[(3, 3, "24q4", 0), (4, 4, "24q4", 1)],
    )
    run = listed(spark, panel(1, 5.0), panel(2, 5.0), panel(5, 5.0))
    current, marked = lifecycle.split_map_versions(t, daily_p, run, t.bad_navteq)
    # 4 was done last time; 1 is new on the list; 3 is repaired and back; an unknown version passes
    assert rows(marked, "mid", "processed") == [(1, 0), (3, 1)]
    assert rows(current, "mid") == [(2,), (3,), (5,)]


def test_unpublish_list(tables, spark, daily_p):
    t = tables(
        panel_state=[
            (1, 1, NOON_TODAY, 2, 0, 7), (2, 2, LONG_AGO, 3, 1, 7), (3, 3, LONG_AGO, 3, 1, 7), (4, 4, NOON_TODAY, 1, 0, 51),
            (5, 5, NOON_TODAY, 4, 0, 7), (6, 6, LONG_AGO, 3, 0, 7),
        ],
        pnl_timeatts=[(6, NOON_TODAY, 2)],
        release_publish=[(100, 1, 1, 1, "ALL", 1.0, 1.0, 2, 2, 1), (99, 1, 1, 1, "ALL", 1.0, 1.0, 3, 3, 1)],
    )
    processed = listed(spark, panel(5, 1.0))
    got = publish.unpublish_list(t, daily_p, processed)
    assert rows(got, "mid", "pid", "desc_text") == [
        (None, 2, "Unpublished - demolished, past cases"), (None, 6, "Unpublish - demolished"),
        (1, 1, "Unpublished - Status changed to 1, 2 or 4"), (4, 4, "Unpublished - Status changed to 1, 2 or 4"),
    ]
    assert (4,) not in rows(publish.unpublish_list(t, daily_p.with_(owner_exception=51), processed), "pid")


def test_demolished_panels_of_the_exempt_owner_are_taken_down(tables, spark, daily_p):
    t = tables(panel_state=[(4, 4, NOON_TODAY, 1, 0, 51)], pnl_timeatts=[(4, NOON_TODAY, 1)])
    got = publish.unpublish_list(t, daily_p.with_(owner_exception=51), listed(spark, panel(5, 1.0)))
    assert rows(got, "pid", "desc_text") == [(4, "Unpublish - demolished")]


def test_quarantine(tables, spark):
    result = spark.createDataFrame(
        [(1, 1, 5, 0.5, 1.0), (2, 2, 5, None, 1.0), (2, 2, 5, None, 1.0), (3, 3, 5, 0.5, -1.0), (4, 4, 5, -0.1, 0.0)],
        "pid BIGINT, mid BIGINT, load_id BIGINT, va DOUBLE, vac DOUBLE",
    )
    t = tables(pnl_to_revise=[(3, 3, None, None, None, 1, None, None, None), (4, 4, None, None, None, None, None, None, None)])
    valid, revise = publish.quarantine(result, t.pnl_to_revise)
    assert rows(valid, "pid") == [(1,)]
    assert rows(revise.filter("null_zero_result"), "pid", "load_id") == [(2, 5), (4, 5)]
    loads = spark.createDataFrame([(9, 9, 7, None, 1.0), (9, 9, 8, None, 1.0), (3, 3, 8, None, 1.0)], result.schema)
    assert rows(publish.quarantine(loads, t.pnl_to_revise)[1].filter("null_zero_result"), "pid", "load_id") == [(9, 7), (9, 8)]


def test_neighbour_choice(tables, spark, daily_p):
    run = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, "SUBSTITUTE")],
                                "mid BIGINT, pid BIGINT, x DOUBLE, y DOUBLE, vac_all_1 DOUBLE, intersection_type STRING")

    def best(pool, p=daily_p):
        return rows(evidence.best_neighbour(evidence.nearest_panels(p, run, pool)), "best_mid_near", "value_difference")

    def pool(*rows_):
        return spark.createDataFrame([(m, m, x, 0.0, v, "ORIGINAL") for m, x, v in rows_], run.schema)

    # the perfect match is the 21st nearest
    near = [(100 + i, float(i + 1), 50.0 + i) for i in range(20)]
    assert best(pool(*near, (200, 30.0, 10.0))) == [(100, 40.0)]
    # same gap: the nearer; unknown value: last
    assert best(pool((5, 9.0, 12.0), (6, 8.0, 8.0), (7, 1.0, None))) == [(6, 2.0)]
    # nothing within the radius
    assert best(pool((5, 5000.1, 10.0))) == []
    assert best(pool((5, 5000.0, 10.0))) == [(5, 0.0)]
    # an entry of its own in the pool is a neighbour at distance zero, unless left out
    own = pool((1, 0.0, 10.0), (2, 5.0, 10.0))
    assert best(own) == [(1, 0.0)]
    assert best(own, daily_p.with_(exclude_self=True)) == [(2, 0.0)]


def test_refreshed_pool(tables, spark):
    t = tables(all_panel=[(1, 99, 0.0, 0.0, 1.0, 5.0, 1, "ORIGINAL", 7, "E")])
    run = listed(spark, panel(1, 8.0), panel(2, 9.0)).withColumn("intersection_type", F.lit("SUBSTITUTE"))
    got = publish.refresh_pool(t.all_panel, run)
    assert rows(got, "mid", "pid", "vac_all_1", "intersection_type", "err_vac_res") == [
        (1, 99, 8.0, "SUBSTITUTE", "E"), (2, 2, 9.0, "SUBSTITUTE", None)
    ]


@pytest.fixture(scope="module")
def driver(spark):
    return DriverTables(spark, "/root/testdata/sf0.001")


def test_driver_tables_match_the_declared_columns(driver):
    from sightline.schemas import ALL, schema

    for name in ALL:
        if hasattr(DriverTables, name):
            assert set(getattr(driver, name).columns) == set(schema(name).fieldNames()), name
