"""Places and distances as column expressions.

``planar`` works in the units of the coordinates. ``metres`` takes lon/lat in degrees: a
place is a point on a sphere in three dimensions, so nothing special happens at 180
degrees or at the poles, and grids and trees use straight distances through the sphere
(chords), which grow with the distances along it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6_371_008.8
METRICS = ("planar", "metres")


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")


def axes(metric: str, x: Column, y: Column) -> list[Column]:
    """Coordinates of a place in which straight distances can be taken."""
    if metric == "planar":
        return [x, y]
    lon, lat = F.radians(x), F.radians(y)
    return [EARTH_RADIUS * F.cos(lat) * F.cos(lon), EARTH_RADIUS * F.cos(lat) * F.sin(lon), EARTH_RADIUS * F.sin(lat)]


def chord(metric: str, length):
    """Straight length of a distance: a number or a column."""
    if metric == "planar":
        return length
    if isinstance(length, Column):
        return 2 * EARTH_RADIUS * F.sin(F.least(length / (2 * EARTH_RADIUS), F.lit(math.pi / 2)))
    return 2 * EARTH_RADIUS * math.sin(min(length / (2 * EARTH_RADIUS), math.pi / 2))


def distance(metric: str, squared_chord: Column) -> Column:
    """Distance of two places by the square of their straight one.

    On the sphere it is told to a millimetre, so places that are equally far but for
    rounding errors are equally far here.
    """
    straight = F.sqrt(squared_chord)
    if metric == "planar":
        return straight
    return F.round(2 * EARTH_RADIUS * F.asin(F.least(straight / (2 * EARTH_RADIUS), F.lit(1.0))), 3)


def slack(metric: str) -> float:
    """By how much straight lengths may be off from the order of ``distance``."""
    return 0.0 if metric == "planar" else 0.002


def square(c: Column) -> Column:
    return c * c


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = a[0] * b[0]
    for u, v in zip(a[1:], b[1:], strict=True):
        total = total + u * v
    return total


def minus(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [u - v for u, v in zip(a, b, strict=True)]


def cross(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def segment_within(metric: str, p: Sequence[Column], a: Sequence[Column], b: Sequence[Column], radius: Column) -> Column:
    """Is place p within ``radius`` of the segment a-b, on the sphere of the arc a-b?

    In the plane it uses no division and no root, so it is exact for whole-number
    coordinates. The arc is the shorter way round.
    """
    e, d = minus(b, a), minus(p, a)
    if metric == "planar":
        along, length2, r2 = dot(d, e), dot(e, e), square(radius)
        return (
            F.when(along <= 0, dot(d, d) <= r2)
            .when(along >= length2, dot(minus(p, b), minus(p, b)) <= r2)
            .otherwise(square(d[0] * e[1] - d[1] * e[0]) <= r2 * length2)
        )
    normal, reach = cross(a, e), square(chord(metric, radius))
    beside = (dot(cross(normal, a), p) >= 0) & (dot(cross(b, normal), p) >= 0) & (dot(normal, normal) > 0)
    # height over the arc's plane against the sine of the radius
    low = F.abs(dot(d, normal)) <= EARTH_RADIUS * F.sin(F.least(radius / EARTH_RADIUS, F.lit(math.pi / 2))) * F.sqrt(dot(normal, normal))
    return (dot(d, d) <= reach) | (dot(minus(p, b), minus(p, b)) <= reach) | (beside & low)


def cell_of(value: Column, size: Column | float) -> Column:
    return F.floor(value / size)
