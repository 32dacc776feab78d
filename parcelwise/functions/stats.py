"""Aggregate expressions: one-pass statistics that merge map-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalar import number


def corrected_skewness(x: Column) -> Column:
    """Sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2).

    NULL below three values; 0 for a constant column.
    """
    x = number(x)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    scaled = F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, F.coalesce(F.when(~F.isnan(scaled), scaled), F.lit(0.0)))


def pairwise_correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL if either is constant there."""
    a, b = number(a), number(b)
    a_seen = F.when(b.isNotNull(), a)
    b_seen = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a_seen) * F.stddev_pop(b_seen))


def r_squared(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST; with a constant target 1 for a perfect fit and else 0; NULL below two rows."""
    both = actual.isNotNull() & predicted.isNotNull()
    y = F.when(both, actual)
    n = F.count(y)
    sse = F.sum(F.pow(actual - predicted, 2))
    sst = F.var_pop(y) * n
    return (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(sse, sst))
    )


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, 2)))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute error in percent of the actual value; zero actuals are left out."""
    return 100 * F.avg(F.try_divide(F.abs(actual - predicted), F.abs(actual)))


def mode_smallest(value: Column, n: Column) -> Column:
    """Most frequent value out of pre-counted (value, n) rows; ties go to the smallest value."""
    return F.min(F.struct((-n).alias("n"), value.alias("v")))["v"]
