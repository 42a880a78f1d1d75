"""Rounding and shares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(c: Column, digits: int = 2) -> Column:
    """Round as the array library behind the usual data frames does: scale, rint, unscale."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


# What a number looks like. The cast alone would also take a type suffix, as in "12d", and
# it raises and catches an exception for every text that is not a number.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"


def text_number(c: Column) -> Column:
    """Text to double; null for what is not a number."""
    value = F.when(c.rlike(NUMBER), F.trim(c)).try_cast("double")
    return F.when(~F.isnan(value), value)


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
