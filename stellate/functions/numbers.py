"""Money, ratios, rounding and banding (SC-6, SC-16..19, SC-23, AGG-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def units(cents: Column) -> Column:
    """Cents as a double in currency units. Sum the cents first: integers add exactly."""
    return cents / F.lit(100.0)


def money(cents: Column) -> Column:
    """A total of cents as currency units, two places."""
    return F.round(units(cents), 2)


def round_up_half(value: Column, places: int = 2) -> Column:
    """Round with ties going up, on the scaled double."""
    scale = F.lit(float(10**places))
    return F.floor(value * scale + F.lit(0.5)) / scale


def zero_if(condition: Column, value: Column) -> Column:
    """0 where the condition holds; a NULL condition keeps the value."""
    return F.when(condition, F.lit(0)).otherwise(value)


def band(value: Column, upper: Sequence[tuple[int, str]], last: str) -> Column:
    """Label of the first band whose upper bound lies above the value.

    A NULL value is below no bound and so falls to the last band.
    """
    label = F.lit(last)
    for bound, name in sorted(upper, reverse=True):
        label = F.when(value < bound, name).otherwise(label)
    return label
