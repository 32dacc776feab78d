"""Histograms, density curves and scatter grids: the data behind each plot."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import c
from ..functions.scalar import equal_width_bin, number
from .order_stats import column_quantiles, grouped_quantiles


def auto_bins(df: DataFrame, column: str) -> tuple[float, float, int]:
    """``low, width, bins`` by the finer of the Sturges and Freedman-Diaconis rules."""
    x = number(c(column))
    n, low, high = df.agg(F.count(x), F.min(x), F.max(x)).head()
    if not n or high == low:
        return (low if n else 0.0) - 0.5, 1.0, 1
    q1, q3 = column_quantiles(df, {column: [0.25, 0.75]}, {column: n})[column]
    sturges = (high - low) / (math.log2(n) + 1)
    freedman = 2 * (q3 - q1) * n ** (-1 / 3)
    width = min(sturges, freedman) if freedman > 0 else sturges
    bins = math.ceil((high - low) / width)
    return low, (high - low) / bins, bins


def histogram(df: DataFrame, column: str, low: float | None = None, width: float | None = None, by: str | None = None) -> DataFrame:
    """``[by,] bin, lower, upper, n``; without a width the automatic rule sets the bins.

    With the automatic rule the last bin also holds the maximum.
    """
    x = number(c(column))
    if width is None:
        low, width, bins = auto_bins(df, column)
        index = F.least(equal_width_bin(x, low, width), F.lit(bins - 1).cast("long"))
    else:
        low = 0.0 if low is None else low
        index = equal_width_bin(x, low, width)
    keys = [c(by).alias(by)] if by else []
    counted = df.where(x.isNotNull()).groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edge = F.lit(low) + F.col("bin") * F.lit(width)
    return counted.select(*([c(by)] if by else []), "bin", edge.alias("lower"), (edge + F.lit(width)).alias("upper"), "n")


def banded_histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """``band, lower, n, share`` over given lower edges; the last band is open above."""
    x = number(c(column))
    band = sum((F.when(x >= e, 1).otherwise(0) for e in edges), F.lit(0)) - 1
    counted = df.where(x >= edges[0]).groupBy(band.cast("long").alias("band")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(x)).head()[0]
    lower = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), (F.col("band") + 1).cast("int"))
    return counted.select("band", lower.alias("lower"), "n", F.try_divide(F.col("n").cast("double"), F.lit(float(total))).alias("share"))


def grid_weights(df: DataFrame, value: Column, low: float, step: float, points: int) -> DataFrame:
    """``point, w``: each value's weight of one split over the two grid points around it, in proportion to its nearness.

    Two partial sums a value and no row more: the left and the right share are summed by the left point and laid out afterwards.
    """
    at = F.least(F.greatest((value - F.lit(low)) / F.lit(step), F.lit(0.0)), F.lit(float(points - 1)))
    left = F.least(F.floor(at), F.lit(points - 2))
    share = at - left
    counted = df.where(value.isNotNull()).groupBy(left.cast("int").alias("left")).agg(F.count(F.lit(1)).alias("n"), F.sum(share).alias("right"))
    both = F.array(F.struct(F.col("left").alias("point"), (F.col("n") - F.col("right")).alias("w")), F.struct((F.col("left") + 1).alias("point"), F.col("right").alias("w")))
    return counted.select(F.inline(both)).groupBy("point").agg(F.sum("w").alias("w"))


def density_curve(df: DataFrame, column: str, points: int = 200, fine: int | None = 4096) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid from minimum to maximum: ``point, x, density``.

    ``fine=None`` is exact: the kernel of every value is summed at every point, ``points`` terms a row, added up in the task that reads it.
    Linear binning otherwise: every value is split over two points of a grid of at least ``fine`` steps, and the kernel is summed over that grid, so
    the kernel work does not depend on the rows. With grid step d and bandwidth h the density is off by at most
    ``d**2 / (8 * h**3 * sqrt(2 * pi))``, the error of a straight line between two grid points of the kernel.
    """
    v = number(c(column))
    n, low, high, spread = df.agg(F.count(v), F.min(v), F.max(v), F.stddev_samp(v)).head()
    if not n or n < 2 or not spread:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = spread * n ** (-0.2)
    step = (high - low) / (points - 1)
    each = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    if fine is None:
        grid = df.where(v.isNotNull()).select(F.lit(1.0).alias("w"), v.alias("at"), each)
        z = (F.lit(low) + F.col("point") * F.lit(step) - F.col("at")) / F.lit(h)
    else:
        times = -(-fine // (points - 1))  # every point of the curve is one of the fine grid
        weights = grid_weights(df, v, low, step / times, (points - 1) * times + 1)
        grid = weights.select("w", (F.col("point") / F.lit(times)).alias("at"), each)
        z = (F.col("point") - F.col("at")) * F.lit(step / h)
    summed = grid.groupBy("point").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
    scale = 1 / (n * h * math.sqrt(2 * math.pi))
    return summed.select("point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), (F.col("s") * F.lit(scale)).alias("density"))


def scatter_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """``x_bin, y_bin, n``: counts on a grid instead of one mark per row."""
    a, b = number(c(x)), number(c(y))
    return df.where(a.isNotNull() & b.isNotNull()).groupBy(
        equal_width_bin(a, 0.0, x_width).alias("x_bin"), equal_width_bin(b, 0.0, y_width).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


def regression_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """``n, slope, intercept, low, high``: the line through a scatter and the ends of its diagonal."""
    a, b = number(c(x)), number(c(y))
    both = F.when(a.isNotNull() & b.isNotNull(), b)
    return df.agg(
        F.regr_count(b, a).alias("n"), F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"),
        F.min(both).alias("low"), F.max(both).alias("high"),
    )


def extreme_groups(df: DataFrame, group: str, value: str, k: int = 5) -> DataFrame:
    """``end, group, n, median`` for the k groups with the highest and the lowest median."""
    medians = grouped_quantiles(df, group, value, [0.5], ["median"]).where(F.col("median").isNotNull())
    top = medians.orderBy(F.desc("median"), c(group)).limit(k).withColumn("end", F.lit("highest"))
    bottom = medians.orderBy("median", c(group)).limit(k).withColumn("end", F.lit("lowest"))
    return top.unionByName(bottom).select("end", c(group), "n", "median")
