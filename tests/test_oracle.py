"""Registered queries against their SQL on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from oracle import oracle_queries
from sightline.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# one query per stage here; all of them are compared on larger tables outside the tests
CHECKED = (
    "ims_input_base", "ims_transport_pivot", "no_calc_split", "freq_band_join", "panel_trip_intersection",
    "nearest20_unbounded", "nearest20_lonlat", "intersection_lonlat", "complexity_index", "control_sum", "recalc_state_step", "publish_replace",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "-"
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def bag(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle_queries())


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows(spark, duck, name):
    got = registered.queries()[name](spark, SF_DIR)
    want = duck.sql(registered.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got.collect(), got.columns) == bag(want.fetchall(), want.columns)
