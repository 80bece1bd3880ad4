"""Whole runs on hand-made tables, with results worked out by hand."""

import datetime as dt

import pytest
from conftest import AS_OF, LONG_AGO, NOON_TODAY, Tables, rows
from pyspark.sql import functions as F

from sightline.params import legacy_full_params, legacy_incremental_params
from sightline.plans.runner import run_full, run_incremental
from sightline.schemas import INPUTS
from sightline.sources.snapshots import CommitConflict, SnapshotStore

LINE = [(-500.0, 0.0), (500.0, 0.0)]


def world(spark, changed_stamp=LONG_AGO, demolished=(), trips=None):
    panels = [(1, 0.0, 0.0, 3), (2, 3000.0, 0.0, 3), (3, 100.0, 0.0, 3), (4, 200.0, 0.0, 1)]
    return Tables(
        spark,
        pnl_main=[(m, m, 100, "K", "S", "25q1") for m, _, _, _ in panels],
        pnl_geom=[(m, x, y) for m, x, y, _ in panels],
        panel_state=[(m, m, changed_stamp if m == 1 else LONG_AGO, s, 0, 7) for m, _, _, s in panels],
        pnl_timeatts=[(pid, NOON_TODAY, 1) for pid in demolished],
        pnl_facemid=[(1, 11, 11, "F11"), (1, 12, 12, "F12"), (2, 21, 21, "F21"), (3, 31, 31, "F31"), (4, 41, 41, "F41")],
        pnl_faces=[(11, 1, 1), (12, 1, 2), (21, 2, 1), (31, 3, 1), (41, 4, 1)],
        code_pnlsubtype=[("K", "EA")],
        vai_vac_res=[(90, 1, 11, "E9"), (100, 1, 11, None), (101, 2, 21, None), (102, 3, 31, None), (103, 4, 41, None)],
        output_round=[(100, 1, "ALL", 10.0, 100.0), (100, 1, "VEH", 0.0, 8.0), (100, 200, "ALL", 70.0, 700.0),
                      (101, 1, "ALL", 12.0, 50.0), (102, 1, "ALL", 0.0, 50.0)],
        trip_routes=trips or [
            (1, "CZE1", "car", "Monday", "WD", 10.0, LINE), (2, "CZE2", "car", "Monday", "WD", 50.0, LINE),
            (3, "CZE1", "car", "Monday", "WD", 0.0, LINE), (4, "CZE1", "car", "Monday", "WD", 9.0, [(0.0, 9000.0)] * 2),
        ],
        resp_weight_input=[("CZE1", _dec("2.000")), ("CZE2", _dec("3.000"))],
        freq_trips_vector=[("WD", "Monday", 0.0, 50.0, _dec("0.5"))],
    )


def _dec(text):
    import decimal

    return decimal.Decimal(text)


@pytest.fixture
def place(spark, tmp_path):
    def make(name="inputs", **kw):
        t = world(spark, **kw)
        for table in INPUTS:
            getattr(t, table).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / name / table))
        return str(tmp_path / name)

    return make


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def test_full_run(spark, place, store, full_p):
    inputs = place()
    assert run_full(store, inputs, full_p) == {"load_id": 1, "listed": 3, "processed": 2, "result_rows": 6}

    assert rows(store.read("no_calc")) == [(3, None)]
    pool = store.read("all_panel")
    assert rows(pool, "mid", "intersection_type", "last_vacid", "vac_all_1") == [
        (1, "ORIGINAL", 100, 10.0), (2, "SUBSTITUTE", 101, 12.0)
    ]
    got = rows(store.read("ccf_result"), "pid", "faceid", "vacid", "respondent_id", "country", "weekdayname",
               "resp_weight", "ts_rots", "va", "vac", "load_id")
    # face 11: 10 / 2.5 = 4 -> 5 passes at 0.8; face 12 is not measured; face 21 borrows the trips: 12 / 2.5 = 4.8
    va11, va21 = pytest.approx(1 - 0.2**5), pytest.approx(1 - (1 - 0.96) ** 5)
    assert got == [
        (1, 11, 100, "CZE1", "CZE", "monday", 2.0, 1.0, va11, 4.0, 1),
        (1, 11, 100, "CZE2", "CZE", "monday", 3.0, 1.5, va11, 6.0, 1),
        (1, 12, 100, "CZE1", "CZE", "monday", 2.0, 1.0, None, None, 1),
        (1, 12, 100, "CZE2", "CZE", "monday", 3.0, 1.5, None, None, 1),
        (2, 21, 101, "CZE1", "CZE", "monday", 2.0, 1.0, va21, 5.0, 1),
        (2, 21, 101, "CZE2", "CZE", "monday", 3.0, 1.5, va21, 7.0, 1),
    ]
    # vac of a face adds up to what was measured
    assert rows(store.read("control_sum"), "faceid", "sum_of_ts_rots", "sum_of_ts_vac") == [
        (11, 2.5, pytest.approx(10.0)), (12, 2.5, None), (21, 2.5, pytest.approx(12.0))
    ]
    assert rows(store.read("panel_log"), "mid", "load_id", "desc_text") == [
        (1, 1, "Processed by load"), (2, 1, "Processed by load")
    ]

    again = SnapshotStore(spark, store.root)
    assert run_full(again, inputs, full_p)["load_id"] == 2
    assert rows(again.read("ccf_result").groupBy("load_id").count()) == [(1, 6), (2, 6)]


def test_full_run_with_nothing_to_do_still_empties_the_inbox(spark, place, store, full_p, tmp_path):
    inputs = place()
    empty = spark.createDataFrame([], "mid BIGINT, x DOUBLE, y DOUBLE")
    empty.write.mode("overwrite").parquet(f"{inputs}/pnl_geom")
    out = store.begin()
    out.replace("panel_inbox", spark.createDataFrame([(4,)], "pid BIGINT"))
    out.commit()
    assert run_full(store, inputs, full_p) == {"load_id": 0, "listed": 0}
    assert store.read("panel_inbox").count() == 0 and store.read("loads").count() == 0


def test_inbox_adds_panels_whatever_their_status(spark, place, store, full_p):
    out = store.begin()
    out.replace("panel_inbox", spark.createDataFrame([(4,), (1,)], "pid BIGINT"))
    out.commit()
    run_full(store, place(), full_p)
    # panel 4 has no result of its own, so it is listed and set aside
    assert rows(store.read("no_calc"), "pid") == [(3,), (4,)]


def test_debug_target_leaves_results_alone(place, store, full_p):
    run_full(store, place(), full_p.with_(debug_target=True))
    assert store.read("ccf_result").count() == 0
    assert store.read("dbg_ccf_result", as_table="ccf_result").count() == 6


def test_older_full_run(place, store):
    p = legacy_full_params(AS_OF, "25q1", input_period=1)
    run_full(store, place(), p)
    got = rows(store.read("ccf_result"), "pid", "faceid", "respondent_id", "weekdayname", "va", "vac")
    # trips 1, 2 and 3 count by weight: 70 / 7 = 10 and 84 / 7 = 12 passes; frequency 11 and 13
    va1, va2 = pytest.approx(1 - (1 - 10 / 11) ** 11), pytest.approx(1 - (1 - 12 / 13) ** 13)
    assert got == [
        (1, 0, "CZE1", "mo", va1, 20.0), (1, 0, "CZE1", "mo", va1, 20.0), (1, 0, "CZE2", "mo", va1, 30.0),
        (2, 0, "CZE1", "mo", va2, 24.0), (2, 0, "CZE1", "mo", va2, 24.0), (2, 0, "CZE2", "mo", va2, 36.0),
    ]


def test_repeated_trip_id_counts_squared(spark, place, store, full_p):
    twice = [(1, "CZE1", "car", "Monday", "WD", 10.0, LINE)] * 2
    run_full(store, place(trips=twice), full_p)
    got = rows(store.read("ccf_result").filter("faceid = 11"), "respondent_id", "ts_rots")
    assert got == [("CZE1", 1.0)] * 4


def test_daily_run_after_full_run(spark, place, store, full_p, daily_p):
    run_full(store, place(), full_p)
    # nothing changed since: nothing is processed or published
    assert run_incremental(store, place(), daily_p) == {"load_id": 0, "listed": 0, "unpublished": 0}
    assert store.read("release_publish").count() == 0

    changed = place("changed", changed_stamp=NOON_TODAY)
    done = run_incremental(store, changed, daily_p, queued_at=dt.datetime(2024, 5, 10, 6))
    assert done == {"load_id": 1, "listed": 1, "unpublished": 0, "processed": 1, "result_rows": 4}
    # two faces double the contacts: 10 / 5 = 2 -> frequency 3, all faces share the panel's value
    va = pytest.approx(1 - (1 / 3) ** 3)
    assert rows(store.read("ccf_result_inc"), "faceid", "respondent_id", "va", "vac") == [
        (11, "CZE1", va, 4.0), (11, "CZE2", va, 6.0), (12, "CZE1", va, 4.0), (12, "CZE2", va, 6.0)
    ]
    published = rows(store.read("release_publish"), "rvloadid", "facepid", "transptype", "periodid", "vac")
    assert published == [(100, 11, "ALL", 1, 10.0), (100, 11, "VEH", 1, 0.0), (101, 11, "ALL", 200, 70.0)]

    # the next day the panel is demolished
    gone = place("gone", changed_stamp=LONG_AGO, demolished=[1])
    assert run_incremental(store, gone, daily_p)["unpublished"] == 1
    assert store.read("release_publish").count() == 0
    assert rows(store.read("panel_log").filter("load_id is null"), "pid", "desc_text") == [(1, "Unpublish - demolished")]


def test_invalid_rows_of_earlier_loads_are_set_aside(spark, place, store, full_p, daily_p):
    run_full(store, place(), full_p)
    out = store.begin()
    bad = spark.createDataFrame([(9, 9, 7, None, -1.0), (8, 8, 7, 0.5, 1.0)],
                                "pid BIGINT, mid BIGINT, load_id BIGINT, va DOUBLE, vac DOUBLE")
    out.append("ccf_result_inc", bad, "load7", as_table="ccf_result")
    out.append("loads_inc", spark.createDataFrame([(7, "x")], "load_id BIGINT, user STRING"), "load7")
    out.commit()
    run_incremental(store, place("changed", changed_stamp=NOON_TODAY), daily_p)
    assert rows(store.read("ccf_result_inc").filter("pid in (8, 9)"), "pid", "load_id") == [(8, 7)]
    assert rows(store.read("pnl_to_revise"), "pid", "load_id", "null_zero_result") == [(9, 7, True)]


def files_of(store, name):
    import glob

    return {part: sorted(glob.glob(f"{store.root}/{path}/*.parquet")) for part, path in store.paths[name].items()}


def test_only_touched_parts_are_written(spark, place, store, full_p, daily_p):
    run_full(store, place(), full_p)
    out = store.begin()
    rows_ = [(r, 10 * pid, 1, 1, "ALL", 1.0, 1.0, pid, pid, 1) for r in (99, 100, 101) for pid in range(1, 200)]
    old = spark.createDataFrame(rows_, out.store.read("release_publish").schema)
    out.replace("release_publish", old)
    out.commit()
    # the first daily run lays an older store's single part out anew
    run_incremental(store, place("one", changed_stamp=NOON_TODAY), daily_p)
    first = files_of(store, "release_publish")
    pool = files_of(store, "all_panel")
    assert len(first) > 100 and all(first.values())
    run_incremental(store, place("two", changed_stamp=NOON_TODAY), daily_p)
    second = files_of(store, "release_publish")
    changed = {part for part in first if first[part] != second[part]}
    assert set(first) == set(second) and {part.split("-")[0] for part in changed} == {"r100", "r101"} and len(changed) == 2
    assert sum(a != b for a, b in zip(pool.values(), files_of(store, "all_panel").values())) <= 1
    left = store.read("release_publish")
    assert left.filter("rvloadid = 99").count() == 199 and left.filter("pid = 1 and rvloadid = 100").count() == 2
    # a panel is taken down: its rows go, the others' files stay
    run_incremental(store, place("gone", demolished=[7]), daily_p)
    third = files_of(store, "release_publish")
    assert sum(second[part] != third.get(part) for part in second) == 2
    assert rows(store.read("release_publish").filter("pid = 7"), "rvloadid") == [(99,)]


def test_clean_history_is_not_read(spark, place, store, full_p, daily_p, monkeypatch):
    run_full(store, place(), full_p)
    for name in ("one", "two"):
        run_incremental(store, place(name, changed_stamp=NOON_TODAY), daily_p)
    assert rows(store.read("load_ledger"), "part", "rows", "invalid") == [("load1", 4, 0), ("load2", 4, 0)]
    opened = []
    read = SnapshotStore.read
    monkeypatch.setattr(SnapshotStore, "read", lambda self, name, *a, **k: opened.append(name) or read(self, name, *a, **k))
    run_incremental(store, place("three", changed_stamp=NOON_TODAY), daily_p)
    assert "ccf_result_inc" not in opened and "load_ledger" in opened


def test_the_later_of_two_runs_starts_again(spark, place, store, full_p):
    other = SnapshotStore(spark, store.root)
    inputs = place()
    late = other.begin()
    assert run_full(store, inputs, full_p)["load_id"] == 1
    late.replace("panel_inbox", spark.createDataFrame([(4,)], "pid BIGINT"))
    with pytest.raises(CommitConflict):
        late.commit()
    assert run_full(other, inputs, full_p)["load_id"] == 2  # the same base: begun anew on what the first has left
    assert rows(SnapshotStore(spark, store.root).read("loads"), "load_id") == [(1,), (2,)]


def test_directories_without_a_pointer_are_removed(spark, place, store, full_p):
    import glob

    run_full(store, place(), full_p)
    dead = store.begin()
    dead.replace("all_panel", store.read("all_panel").limit(0))
    dead.replace_parts("release_publish", store.read("release_publish"), F.lit("x"))
    before = rows(store.read("all_panel"))
    assert store.clean(hours=24) == []
    gone = store.clean(hours=0)
    assert any(g.startswith("tables/all_panel/all-2-") for g in gone)
    assert rows(SnapshotStore(spark, store.root).read("all_panel")) == before
    assert run_full(store, place(), full_p)["load_id"] == 2
    assert not [d for d in glob.glob(f"{store.root}/tables/all_panel/all-2-*")]


def test_failed_run_changes_nothing(spark, place, store, full_p):
    run_full(store, place(), full_p)
    before = rows(store.read("all_panel"))
    out = store.begin()
    out.replace("all_panel", store.read("all_panel").limit(0))
    # no commit
    again = SnapshotStore(spark, store.root)
    assert again.run_id == 1 and rows(again.read("all_panel")) == before
    assert again.read("ccf_result").agg(F.count("*")).first()[0] == 6


def test_older_daily_run(spark, place, store, full_p):
    run_full(store, place(), full_p)
    # the older form reads period 2 and publishes other releases
    p = legacy_incremental_params(AS_OF, "25q1", vac_period=1, input_period=1, ids_period=1, ims_periods=(200,))
    changed = place("changed", changed_stamp=NOON_TODAY)
    assert run_incremental(store, changed, p)["processed"] == 1
    got = rows(store.read("ccf_result_inc"), "pid", "faceid", "respondent_id", "weekdayname", "vac")
    assert got == [(1, 0, "CZE1", "mo", 20.0), (1, 0, "CZE1", "mo", 20.0), (1, 0, "CZE2", "mo", 30.0)]
    assert rows(store.read("release_publish"), "rvloadid", "facepid", "transptype") == [
        (104, 11, "ALL"), (104, 11, "VEH"), (105, 11, "ALL")
    ]
