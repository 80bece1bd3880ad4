"""Numeric rules of the pipeline as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline import constants as c


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def environment_name(code: Column) -> Column:
    pairs = list(c.ENVIRONMENT_NAMES.items())
    out = F.when(code == pairs[0][0], pairs[0][1])
    for key, name in pairs[1:]:
        out = out.when(code == key, name)
    return out.otherwise(code)


def visibility(vac: Column, rots: Column, *, needs_vac: bool) -> Column:
    """vac / rots. Only the all-transport ratio also requires a nonzero vac."""
    usable = rots != 0
    if needs_vac:
        usable = usable & (vac != 0)
    return F.when(usable, ratio(vac, rots))


def contact_frequency(ts_va: Column, whole: bool) -> Column:
    more = F.floor(ts_va) + 1 if whole else ts_va + 1
    return F.when(ts_va > 1, more.cast("double")).otherwise(F.lit(1.0))


def reach(adjusted: Column, frequency: Column, cap: float, clamp: bool) -> Column:
    """Probability of seeing a panel at least once in ``frequency`` passes."""
    formula = 1 - F.pow(1 - adjusted, frequency)
    if clamp:
        return (
            F.when(adjusted <= 0, 0.0).when(adjusted >= 1, 1.0).when(frequency >= cap, 1.0).otherwise(formula)
        )
    return F.when(frequency < cap, formula).otherwise(1.0)


def half_even(value: Column) -> Column:
    """Whole number, halves to the even neighbour, as rounding of doubles does."""
    return F.rint(value)


def complexity(segments: Column, nodes: Column) -> Column:
    """Segments per node to three places, halves away from zero."""
    exact = F.try_divide(segments.cast("decimal(18,0)"), nodes.cast("decimal(18,0)"))
    return F.round(exact, 3).cast("decimal(12,3)")


def difficulty(index: Column) -> Column:
    low, high = F.lit(c.DIFFICULTY_MEDIUM_FROM).cast("decimal(12,3)"), F.lit(c.DIFFICULTY_MEDIUM_TO).cast("decimal(12,3)")
    return (
        F.when(index < low, c.DIFFICULTY_LOW)
        .when(index.between(low, high), c.DIFFICULTY_MEDIUM)
        .when(index > high, c.DIFFICULTY_HIGH)
        .otherwise(c.DIFFICULTY_UNDEFINED)
    )
