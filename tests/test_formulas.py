"""Numeric rules, with results worked out by hand."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sightline.functions import formulas as f


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(v):
    return F.lit(v).cast("double")


def test_visibility_guards(spark):
    # vac = 0, rots = 10: no ratio for all transport, zero for the others
    assert value(spark, f.visibility(lit(0), lit(10), needs_vac=True)) is None
    assert value(spark, f.visibility(lit(0), lit(10), needs_vac=False)) == 0.0
    assert value(spark, f.visibility(lit(5), lit(0), needs_vac=False)) is None
    assert value(spark, f.visibility(lit(None), lit(10), needs_vac=False)) is None


def test_zero_division_gives_null(spark):
    assert value(spark, f.ratio(lit(1), lit(0))) is None


def reach(spark, ts_va, whole, cap, clamp):
    df = spark.createDataFrame([(ts_va,)], "ts_va DOUBLE")
    df = df.withColumn("freq", f.contact_frequency(F.col("ts_va"), whole))
    df = df.withColumn("adj", f.ratio(F.col("ts_va"), F.col("freq")))
    return df.select("freq", "adj", f.reach(F.col("adj"), F.col("freq"), cap, clamp).alias("va")).first()


def test_whole_frequency(spark):
    r = reach(spark, 2.5, True, 100, True)
    assert (r.freq, r.adj) == (3.0, pytest.approx(2.5 / 3))
    assert r.va == pytest.approx(1 - (1 / 6) ** 3)


def test_fractional_frequency(spark):
    r = reach(spark, 2.5, False, 20, False)
    assert (r.freq, r.adj) == (3.5, pytest.approx(2.5 / 3.5))
    assert r.va == pytest.approx(1 - (1 / 3.5) ** 3.5)


def test_edges_of_the_clamped_formula(spark):
    for adj, freq, want in ((1.0, 1.0, 1.0), (0.0, 1.0, 0.0), (-0.2, 1.0, 0.0), (0.5, 100.0, 1.0)):
        assert value(spark, f.reach(lit(adj), lit(freq), 100, True)) == want
    assert reach(spark, None, True, 100, True).va is None


def test_frequency_cap_of_the_daily_formula(spark):
    assert value(spark, f.reach(lit(0.01), lit(20), 20, False)) == 1.0
    assert value(spark, f.reach(lit(0.01), lit(19.9), 20, False)) == pytest.approx(1 - 0.99**19.9)


def test_rounding(spark):
    assert [value(spark, f.half_even(lit(v))) for v in (2.5, 3.5, 2.51)] == [2.0, 4.0, 3.0]
    assert str(value(spark, f.complexity(F.lit(2001), F.lit(2000)))) == "1.001"


def test_difficulty(spark):
    df = spark.createDataFrame([(3, 2), (29, 20), (22, 10), (2201, 1000), (3, 0), (3, None)], "s INT, n INT")
    got = df.select(f.complexity(F.col("s"), F.col("n")).alias("ix"), F.col("s")).select(
        F.col("ix").cast("string").alias("ix"), f.difficulty(F.col("ix")).alias("d")
    )
    assert rows(got) == sorted([
        ("1.500", "MEDIUM (Standard)"), ("1.450", "LOW (Linear/Simple)"), ("2.200", "MEDIUM (Standard)"),
        ("2.201", "HIGH (Complex Mesh - slow)"), (None, "UNDEFINED"), (None, "UNDEFINED"),
    ], key=lambda t: tuple((v is not None, v) for v in t))


def test_environment_names(spark):
    df = spark.createDataFrame([("EA",), ("EB",), ("EC",), (None,)], "e STRING")
    assert rows(df.select(f.environment_name(F.col("e")).alias("e"))) == [(None,), ("EC",), ("Indoor",), ("Roadside",)]
