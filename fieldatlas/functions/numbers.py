"""Rounding and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half up on the binary value, as ``floor(x * 10^n + 0.5) / 10^n``."""
    scale = float(10 ** digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def round_even(value: Column, digits: int) -> Column:
    """Round the scaled binary value, ties to even."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that is null, not an error, for a zero denominator."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def as_number(value: Column) -> Column:
    """Double or null, never an error."""
    return value.try_cast("double")


def as_id(value: Column) -> Column:
    """64-bit id or null; accepts ids that arrive as doubles or text like '12.0'."""
    return value.try_cast("double").try_cast("bigint")


def sqrt_scale(value: Column, low: Column, high: Column, lo: float, hi: float) -> Column:
    """Square-root scaling of ``value`` from [low, high] to [lo, hi]; the middle if flat."""
    span = F.sqrt(high) - F.sqrt(low)
    return F.when(span == 0, F.lit((lo + hi) / 2)).otherwise(
        F.lit(lo) + F.lit(hi - lo) * (F.sqrt(value) - F.sqrt(low)) / span)
