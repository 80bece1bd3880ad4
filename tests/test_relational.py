"""Ordering and NULL rules of the table operators."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sightline.operators import relational as rel
from sightline.operators.bands import band_join, deal


def test_newest_of_one_column_is_a_hash_aggregate_with_the_same_rows(spark):
    runs = spark.createDataFrame(
        [(1, 10), (1, None), (2, 5), (2, 7), (3, None), (3, None), (None, 4), (None, 6)], "mid BIGINT, vacid BIGINT")
    for way in ("desc", "asc"):
        got = rel.first_per_key(runs, ["mid"], {"vacid": way})
        assert rows(got) == rows(rel.first_per_group(runs, ["mid"], {"vacid": way}))
        assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_descending_puts_null_first(spark):
    runs = spark.createDataFrame([(1, 10), (1, None), (2, 5), (2, 7)], "mid BIGINT, vacid BIGINT")
    assert rows(rel.first_per_group(runs, ["mid"], {"vacid": "desc"})) == [(1, None), (2, 7)]
    assert rows(rel.first_per_group(runs, ["mid"], {"vacid": "asc"})) == [(1, 10), (2, 5)]


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 9, "b"), (1, 9, "a"), (1, 9, None)], "k INT, v INT, t STRING")
    assert rows(rel.first_per_group(df, ["k"], {"v": "desc"})) == [(1, 9, "a")]


def test_one_row_per_key_and_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = rel.first_per_group(df, ["k"], {"v": "desc"})._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_not_in_lets_nothing_pass_if_the_list_has_a_null(spark):
    df = spark.createDataFrame([(2,), (1,), (None,)], "pid BIGINT")
    with_null = spark.createDataFrame([(1,), (None,)], "pid BIGINT")
    plain = spark.createDataFrame([(1,)], "pid BIGINT")
    empty = spark.createDataFrame([], "pid BIGINT")
    assert rows(rel.not_in(df, with_null, "pid")) == []
    assert rows(rel.not_in(df, plain, "pid")) == [(2,)]
    assert rows(rel.not_in(df, empty, "pid")) == [(None,), (1,), (2,)]


def test_update_leaves_unmatched_rows_and_takes_nulls_from_matched(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    source = spark.createDataFrame([(1, None)], "k INT, v STRING")
    assert rows(rel.update_from(target, source, ["k"], {"v": "v"})) == [(None, "c"), (1, None), (2, "b")]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v INT")
    assert rows(rel.delete_where(df, F.col("v") > 2)) == [(None,), (1,)]


def test_upsert_keeps_unset_columns_and_adds_every_new_row(spark):
    old = spark.createDataFrame([(1, "old", 5), (2, "old", 6)], "k INT, kept STRING, v INT")
    new = spark.createDataFrame([(1, 50), (3, 70), (3, 70)], "k INT, v INT")
    got = rows(rel.upsert(old, new, "k", ["v"]), "k", "kept", "v")
    assert got == [(1, "old", 50), (2, "old", 6), (3, None, 70), (3, None, 70)]


def test_replace_only_within_the_scope(spark):
    old = spark.createDataFrame([(1, 99, "a"), (1, 100, "b"), (2, 100, "c")], "pid INT, release INT, v STRING")
    new = spark.createDataFrame([(1, 100, "n")], "pid INT, release INT, v STRING")
    got = rel.replace_by_key(old, new, "pid", F.col("release").isin(100, 101), new)
    assert rows(got) == [(1, 99, "a"), (1, 100, "n"), (2, 100, "c")]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_long_and_short_key_lists_give_the_same(spark, threshold):
    """With and without a broadcast; one key has a third of all rows."""
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 2, id % 7) AS k", "id AS v")
    listed = spark.createDataFrame([(1,), (2,), (3,), (3,)], "k BIGINT")

    def run():
        return rows(rel.per_listed_key(df, listed, "k", lambda d: d.groupBy("k").agg(F.max("v").alias("v"))))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert run() == [(1, 995), (2, 999), (3, 997)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_band_edges(spark):
    trips = spark.createDataFrame([(1, "WD", 50.0), (2, "WD", 50.1), (3, "WD", 200.0), (4, "WE", 60.0)],
                                  "sid INT, kind STRING, freq DOUBLE")
    bands = spark.createDataFrame([("WD", 50.0, 200.0, 0.5)], "t STRING, lo DOUBLE, hi DOUBLE, prob DOUBLE")
    got = band_join(trips, bands, [("kind", "t")], "freq", "lo", "hi")
    assert rows(got, "sid") == [(2,), (3,)]


def test_first_per_key_chooses_as_first_per_group(spark):
    df = spark.createDataFrame(
        [(1, 10, "b", 1), (1, None, "a", 2), (1, None, None, 3), (2, 5, "x", 4), (2, 7, "x", 5), (None, 1, None, None), (None, 1, None, None)],
        "k INT, v BIGINT, t STRING, n INT")
    for order in ({"v": "desc"}, {"v": "asc"}, {"t": "asc", "v": "desc"}, {}):
        assert rows(rel.first_per_key(df, ["k"], order)) == rows(rel.first_per_group(df, ["k"], order))
    assert rows(rel.first_per_key(df.select("k"), ["k"], {})) == [(None,), (1,), (2,)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_are_reduced_before_the_shuffle_and_below_a_short_list(spark):
    runs = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) AS mid", "id AS vacid", "cast(id AS string) AS e")
    listed = spark.range(20).selectExpr("id AS mid")

    def newest(r):
        return rel.first_per_key(r, ["mid"], {"vacid": "desc"})

    got = rel.per_listed_key(runs, listed, "mid", newest)
    want = rows(rel.first_per_group(rel.is_in(runs, listed, "mid"), ["mid"], {"vacid": "desc"}))
    assert rows(got) == want and len(want) == 13
    short = _plan(got)
    assert short.index("partial_min_by") < short.index("BroadcastHashJoin")  # the join stands below
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long = rel.per_listed_key(runs, listed, "mid", newest)
        assert rows(long) == want
        plan = _plan(long)
        assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(mid") < plan.index("partial_min_by")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bands_are_even_where_one_band_takes_most_rows(spark):
    df = spark.range(4000).selectExpr("'WD' AS kind", "if(id % 3 = 0, 100 + id / 4000, id / 10) AS v", "id")
    df = df.unionByName(spark.createDataFrame([("WD", None, -1), ("WE", 5.0, -2), ("WD", 50.0, -3)], df.schema))
    bands = spark.createDataFrame([("WD", 0.0, 50.0, 1), ("WD", 50.0, 100.0, 2), ("WD", 100.0, 101.0, 3), ("WD", 30.0, 300.0, 4),
                                   ("WD", 9.0, 9.0, 5), ("WD", 9.0, 3.0, 6), ("WE", None, 9.0, 7)], "day STRING, lo DOUBLE, hi DOUBLE, n INT")
    want = rows(df.crossJoin(bands).filter("kind = day and v > lo and v <= hi"), "id", "n")
    got = band_join(df, bands, [("kind", "day")], "v", "lo", "hi")
    assert got.columns == ["kind", "v", "id", "day", "lo", "hi", "n"] and rows(got, "id", "n") == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        third = band_join(df, bands.filter("n = 3"), [("kind", "day")], "v", "lo", "hi")
        parts = third.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in parts) == third.count() and max(r["count"] for r in parts) < 600
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert rows(band_join(df.limit(0), bands, [("kind", "day")], "v", "lo", "hi")) == []


def test_many_keys_in_a_small_file_are_not_broadcast(spark, tmp_path):
    """A million keys in order are few bytes of Parquet; what counts for a join is the size of the rows."""
    from sightline.session import ESTIMATE, estimate_by_rows
    from sightline.sources.driver_tables import DriverTables

    before = spark.conf.get(ESTIMATE)
    spark.range(1_200_000).selectExpr(
        "id as p_partkey", "'part of the table' as p_name", "'Brand#11' as p_brand", "'LARGE' as p_type",
        "cast(id % 50 as int) as p_size", "1.0D as p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    try:
        spark.conf.set(ESTIMATE, "1.0")
        t = DriverTables(spark, str(tmp_path))
        plan = t.pnl_main.join(t.pnl_geom, "mid")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        spark.conf.set(ESTIMATE, "3.0")
        estimate_by_rows(spark)
        assert spark.conf.get(ESTIMATE) == "3.0"
    finally:
        spark.conf.set(ESTIMATE, before)


def test_interval_of_a_value_is_the_number_of_cut_points_below(spark):
    values = [None, float("nan"), -1.0, 0.0, 0.5, 9.0, 9.5, 63.0, 64.0, *[float(v) for v in range(0, 80, 7)]]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for n in (0, 1, 7, 8, 9, 63):
        cuts = [float(c) for c in range(n)]
        want = [(v, n if v != v else sum(c < v for c in cuts)) for v in values if v is not None]
        assert sorted(map(str, rows(deal(df, "v", cuts)))) == sorted(map(str, want))
