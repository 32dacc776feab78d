"""Cleaning: drop sparse columns, fill gaps, filter outliers, narrow types."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from .. import fixed_values as fixed
from ..functions.names import c, long_numbers, number_literal, numeric_columns, per_column, present, quote, replace_columns, text_columns, text_literal
from ..functions.stats import mode_smallest
from .encode import Scale
from .order_stats import DIRECT_LIMIT, column_quantiles, sketch_expression
from .profile import missing_counts, modes


def drop_ids(df: DataFrame, ids: list[str] = fixed.ID_COLUMNS) -> DataFrame:
    return df.drop(*ids)


# --- sparse columns --------------------------------------------------------

def sparse_columns(
    df: DataFrame, threshold: float = fixed.MISSING_THRESHOLD, columns: list[str] | None = None, rounded_percent: bool = False,
) -> list[str]:
    """Columns whose missing fraction is strictly above the threshold.

    ``rounded_percent`` compares the percentage rounded to two decimals, as
    the listed variant does.
    """
    names = present(df, columns) if columns is not None else df.columns
    if not names:
        return []
    n, gaps = missing_counts(df, names)
    if n == 0:
        return []
    if rounded_percent:
        return [x for x in names if round(100 * gaps[x] / n, 2) > 100 * threshold]
    return [x for x in names if gaps[x] / n > threshold]


def drop_sparse(df: DataFrame, threshold: float = fixed.MISSING_THRESHOLD, columns: list[str] | None = None, rounded_percent: bool = False) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, columns, rounded_percent))


# --- imputation ------------------------------------------------------------

@dataclass(frozen=True)
class Fill:
    """Fitted replacement values; a column without a present value has none."""

    values: dict = field(default_factory=dict)


def fit_fill(
    df: DataFrame,
    numeric: str = "median",
    text: str = "most_frequent",
    columns: list[str] | None = None,
    only_missing: bool = False,
    constants: tuple = (0.0, "missing"),
    relative_error: float | None = None,
    gaps: tuple[int, dict[str, int]] | None = None,
) -> Fill:
    """Learn fills: numbers by median, mean, mode or constant, text by mode or constant.

    ``gaps`` takes an earlier result of ``missing_counts`` and saves that job.
    """
    names = present(df, columns) if columns is not None else df.columns
    numbers = [n for n in numeric_columns(df) if n in set(names)]
    labels = [n for n in text_columns(df) if n in set(names)]
    counts = None
    if only_missing and gaps is None:
        gaps = missing_counts(df, numbers + labels) if numbers + labels else (0, {})
    if gaps is not None:
        n_rows, n_missing = gaps
        counts = {n: n_rows - n_missing[n] for n in numbers}
    if only_missing:
        numbers = [n for n in numbers if n_missing[n]]
        labels = [n for n in labels if n_missing[n]]
    values: dict = {}
    if numeric == "median":
        values |= {n: q[0] for n, q in column_quantiles(df, {n: [0.5] for n in numbers}, counts, relative_error=relative_error).items()}
    elif numeric == "mean":
        values |= {n: r["mean"] for n, r in per_column(df, numbers, mean=F.avg("x")).items()}
    elif numeric == "constant":
        values |= {n: constants[0] for n in numbers}
    elif numeric == "most_frequent":
        if numbers:
            counted = long_numbers(df, numbers).groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
            top = counted.groupBy("column").agg(mode_smallest(F.col("x"), F.col("n")).alias("mode"))
            values |= {r["column"]: r["mode"] for r in top.collect()}
    else:
        raise ValueError(f"unknown numeric strategy {numeric!r}")
    if text == "most_frequent":
        values |= modes(df, labels)
    elif text == "constant":
        values |= {n: constants[1] for n in labels}
    else:
        raise ValueError(f"unknown text strategy {text!r}")
    return Fill({k: v for k, v in values.items() if v is not None})


def fit_fill_and_scale(df: DataFrame, names: list[str], numeric: str = "median") -> tuple[dict, Scale]:
    """Fills of number columns together with the scale of the filled columns.

    Count, mean and variance of the present values come with the medians, or in a large table with the sketches that
    the search for the medians begins with, in one pass; the filled column's mean and deviation follow from them.
    """
    n_rows = df.count()
    x = F.col("x")
    moments = {"n": F.count(x), "mean": F.avg(x), "var": F.var_pop(x), "low": F.min(x), "high": F.max(x)}
    fuse = numeric == "median" and n_rows <= DIRECT_LIMIT
    middle = {} if numeric != "median" else {"median": F.percentile(x, F.lit(0.5))} if fuse else {"sketch": sketch_expression("x")}
    found = per_column(df, names, **moments, **middle)
    if numeric == "median" and not fuse:
        medians = column_quantiles(df, {n: [0.5] for n in found}, {n: r["n"] for n, r in found.items()}, sketches={n: r["sketch"] for n, r in found.items()})
        found = {n: r | {"median": medians[n][0]} for n, r in found.items()}
    fill, mean, deviation = {}, {}, {}
    for n in [n for n in names if n in found]:
        r = found[n]
        fill[n] = r["median"] if numeric == "median" else r["mean"]
        gaps = n_rows - r["n"]
        if r["low"] == r["high"] and (not gaps or fill[n] == r["low"] or numeric == "mean"):
            fill[n] = mean[n] = r["low"]  # constant: moments would leave rounding dust to divide by
            deviation[n] = 1.0
            continue
        mean[n] = (r["n"] * r["mean"] + gaps * fill[n]) / n_rows
        var = (r["n"] * (r["var"] + (r["mean"] - mean[n]) ** 2) + gaps * (fill[n] - mean[n]) ** 2) / n_rows
        deviation[n] = math.sqrt(var) or 1.0
    return fill, Scale(mean, deviation)


def apply_fill(df: DataFrame, fill: Fill) -> DataFrame:
    """Replace missing values; a filled number column becomes double."""
    changed = {}
    for f in df.schema:
        if f.name in fill.values:
            q, value = quote(f.name), fill.values[f.name]
            if isinstance(f.dataType, T.NumericType):
                x = f"CAST({q} AS double)"
                changed[f.name] = f"coalesce(nullif({x}, double('NaN')), {number_literal(value)})"
            else:
                changed[f.name] = f"coalesce({q}, {text_literal(value)})"
    return replace_columns(df, changed)


# --- outliers --------------------------------------------------------------

@dataclass(frozen=True)
class Bounds:
    column: str
    low: float
    high: float


def fit_iqr_bounds(df: DataFrame, column: str = fixed.TARGET, factor: float = fixed.IQR_FACTOR, relative_error: float | None = None) -> Bounds:
    q1, q3 = column_quantiles(df, {column: [0.25, 0.75]}, relative_error=relative_error)[column]
    if q1 is None:
        raise ValueError(f"{column} has no values")
    reach = factor * (q3 - q1)
    return Bounds(column, q1 - reach, q3 + reach)


def apply_bounds(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Keep rows inside the bounds, ends included; a missing value is outside."""
    return df.where(c(bounds.column).between(bounds.low, bounds.high) & ~F.isnan(c(bounds.column).cast("double")))


def outlier_report(df: DataFrame, bounds: Bounds) -> DataFrame:
    """``n_rows, n_kept, n_removed, lower, upper`` of the filter."""
    kept = F.count_if(c(bounds.column).between(bounds.low, bounds.high))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), kept.alias("n_kept"), (n - kept).alias("n_removed"),
                  F.lit(bounds.low).alias("lower"), F.lit(bounds.high).alias("upper"))


# --- narrow types ----------------------------------------------------------

FLOAT_LIMIT = 3.4028234663852886e38
INT_LIMITS = (-2147483648, 2147483647)


def narrow_types(df: DataFrame) -> DataFrame:
    """Doubles to float and longs to int where the observed range lies strictly inside the narrow one.

    Float columns lose precision, so no plan calls this on its own.
    """
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.LongType))]
    kinds = dict(df.dtypes)
    if not wide:
        return df
    value = {n: f"nullif({quote(n)}, double('NaN'))" if kinds[n] == "double" else quote(n) for n in wide}
    ends = df.selectExpr(*[f"{f}({value[n]}) AS {f}{i}" for i, n in enumerate(wide) for f in ("min", "max")]).head()
    target = {}
    for i, n in enumerate(wide):
        low, high = ends[2 * i], ends[2 * i + 1]
        if low is None:
            continue
        if kinds[n] == "double" and low > -FLOAT_LIMIT and high < FLOAT_LIMIT:
            target[n] = "float"
        elif kinds[n] == "bigint" and low > INT_LIMITS[0] and high < INT_LIMITS[1]:
            target[n] = "int"
    return replace_columns(df, {n: f"CAST({quote(n)} AS {t})" for n, t in target.items()})
