from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sightline.params import full_params, incremental_params  # noqa: E402
from sightline.schemas import ALL, schema  # noqa: E402
from sightline.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 5, 10)
NOON_TODAY = dt.datetime(2024, 5, 10, 12)
NOON_YESTERDAY = dt.datetime(2024, 5, 9, 12)
LONG_AGO = dt.datetime(2024, 1, 1, 12)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "4", 2)
    yield session
    session.stop()


@pytest.fixture
def full_p():
    return full_params(AS_OF, "25q1")


@pytest.fixture
def daily_p():
    return incremental_params(AS_OF, "25q1")


class Tables:
    """Hand-made tables; those not given are empty."""

    def __init__(self, spark, **rows):
        self._spark, self._rows, self._made = spark, rows, {}

    def __getattr__(self, name):
        if name.startswith("_") or name not in ALL:
            raise AttributeError(name)
        if name not in self._made:
            wanted = schema(name)
            values = [tuple(r.get(f) for f in wanted.fieldNames()) if isinstance(r, dict) else r
                      for r in self._rows.get(name, [])]
            self._made[name] = self._spark.createDataFrame(values, wanted)
        return self._made[name]


@pytest.fixture
def tables(spark):
    return lambda **rows: Tables(spark, **rows)


def rows(df, *names):
    """Rows as sorted tuples, NULLs first."""
    picked = [tuple(r[n] for n in (names or df.columns)) for r in df.collect()]
    return sorted(picked, key=lambda t: tuple((v is not None, v) for v in t))
