"""Rounding and ratio rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column) -> Column:
    return F.bround(value).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(F.lit(100.0) * numerator, denominator.cast("double"))


def pct_text(numerator: Column, denominator: Column) -> Column:
    """``12.34%``, or ``n/a`` on an empty denominator."""
    return F.coalesce(F.concat(fixed(pct(numerator, denominator), 2), F.lit("%")), F.lit("n/a"))


def fixed(value: Column, digits: int) -> Column:
    """Plain decimal text with a fixed number of digits; null stays null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))


def cycles_missed(gap_seconds: Column, median_seconds: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), round_half_even(gap_seconds / median_seconds) - 1)
