"""Half-open band join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTERVALS = 64
_GROUP = 8  # cut points looked through at once


def band_join(
    rows: DataFrame, bands: DataFrame, on: Sequence[tuple[str, str]], value: str, low: str, high: str, intervals: int = INTERVALS
) -> DataFrame:
    """Rows with the bands they fall in: low < value <= high, plus equal keys.

    The values are cut at their quantiles into intervals with like numbers of rows, and
    a band stands in each interval it meets. Keys and interval make it an equality join
    whose keys are even also where one band takes most rows; the band test is what is
    left to check. A value is in one interval, so no pair shows up twice.
    """
    cuts = cut_points(rows, value, intervals)
    return meet_bands(deal(rows, value, cuts), bands, on, value, low, high, cuts)


def cut_points(rows: DataFrame, value: str, intervals: int = INTERVALS) -> list[float]:
    """The quantiles between the intervals: one row of fewer than ``intervals`` numbers."""
    shares = F.array(*[F.lit(i / intervals) for i in range(1, intervals)])
    return rows.agg(F.array_distinct(F.percentile_approx(F.col(value).cast("double"), shares, 1000))).first()[0] or []


def deal(rows: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Rows that have a value, with its ``_interval``: the number of cut points below."""
    groups = [cuts[i:i + _GROUP] for i in range(0, len(cuts), _GROUP)]
    known = rows.filter(F.col(value).isNotNull())
    if not groups:
        return known.withColumn("_interval", F.lit(0))
    array = lambda numbers: F.array(*[F.lit(float(n)) for n in numbers])
    # first the groups that are all below, then the points of the next one
    whole = known.withColumn("_group", F.size(F.filter(array(g[-1] for g in groups), lambda c: c < F.col(value))))
    part = F.size(F.filter(F.get(F.array(*[array(g) for g in [*groups, []]]), F.col("_group")), lambda c: c < F.col(value)))
    return whole.withColumn("_interval", F.least(F.col("_group") * _GROUP, F.lit(len(cuts))) + part).drop("_group")


def meet_bands(
    dealt: DataFrame, bands: DataFrame, on: Sequence[tuple[str, str]], value: str, low: str, high: str, cuts: Sequence[float]
) -> DataFrame:
    """Rows of ``deal``, joined with others or not, with the bands they fall in."""
    points = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    first, last = F.size(F.filter(points, lambda c: c <= F.col(low))), F.size(F.filter(points, lambda c: c < F.col(high)))
    met = bands.filter(F.col(low) < F.col(high)).withColumn("_interval", F.explode(F.sequence(first, last)))
    condition = dealt["_interval"] == met["_interval"]
    for a, b in on:
        condition = condition & (dealt[a] == met[b])
    inside = (dealt[value] > met[low]) & (dealt[value] <= met[high])
    return dealt.join(met, condition & inside).drop("_interval")
