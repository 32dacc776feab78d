"""Scalar expressions with the null rules of missing-value arithmetic.

A comparison with a missing value is false, and "differs" is true, where SQL
would answer NULL; sums and products of a missing value stay missing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number(x: Column) -> Column:
    """The value as a double, NaN as NULL: every numeric statistic counts NaN as missing."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def clip_low(x: Column, low: float = 0) -> Column:
    """``max(x, low)`` that keeps NULL (``greatest`` would skip it)."""
    return F.when(x < low, F.lit(low)).otherwise(x)


def positive_flag(x: Column) -> Column:
    """1 where x > 0, else 0; missing counts as 0."""
    return F.coalesce(x > 0, F.lit(False)).cast("int")


def differs_flag(a: Column, b: Column) -> Column:
    """1 where the two differ; a missing value on either side counts as different."""
    return F.coalesce(a != b, F.lit(True)).cast("int")


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b, with 0 for a zero divisor or a missing operand."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def relative_band(x: Column, width: float) -> tuple[Column, Column]:
    """Lower and upper end of ``x`` plus or minus a relative width."""
    return x * (1 - width), x * (1 + width)


def equal_width_bin(x: Column, low: float, width: float) -> Column:
    """Index of the half-open bin ``[low + k*width, low + (k+1)*width)``."""
    return F.floor((x - F.lit(low)) / F.lit(width)).cast("long")
