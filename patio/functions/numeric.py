"""Numeric column helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_stable(x: Column, digits: int = 2) -> Column:
    """Round half away from zero, absorbing float-summation noise at exact ties first."""
    return F.round(F.round(x, digits + 6), digits)


def round_half_up(x: Column, digits: int = 0) -> Column:
    """floor(x + 0.5) at the given number of decimals (ties go up, also below zero)."""
    scale = float(10 ** digits)
    return F.floor(F.round(x * F.lit(scale), 6) + F.lit(0.5)) / F.lit(scale)


def pct_change(x: Column, previous: Column) -> Column:
    """Percent change against a previous value; null when there is none or it is zero."""
    return (x - previous) * F.lit(100.0) / F.nullif(previous, F.lit(0.0))


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, or the default when the denominator is zero or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))
