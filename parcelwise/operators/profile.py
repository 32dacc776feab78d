"""Profiles of a table: one aggregation for all columns, long results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.hashing import row_hash
from ..functions.names import c, long_numbers, long_row, numeric_columns, per_column, quote, stacked, text_columns, text_literal
from ..functions.scalar import number
from ..functions.stats import corrected_skewness, mode_smallest
from .order_stats import DIRECT_LIMIT, column_quantiles, sketch_expression


def missing_test(df: DataFrame, name: str) -> str:
    """SQL condition for a missing value: NULL, and NaN in floating columns."""
    q = quote(name)
    return f"({q} IS NULL OR isnan({q}))" if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else f"({q} IS NULL)"


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> tuple[int, dict[str, int]]:
    """Row count and missing values per column, in one job."""
    names = columns or df.columns
    row = df.selectExpr("count(*) AS n", *[f"count_if({missing_test(df, n)}) AS m{i}" for i, n in enumerate(names)]).head()
    return row[0], dict(zip(names, row[1:]))


def missing_profile(df: DataFrame, columns: list[str] | None = None, only_missing: bool = True) -> DataFrame:
    """``column, n_missing, fraction, percent`` sorted by count, most first."""
    names = columns or df.columns
    gaps = [missing_test(df, n) for n in names]
    counted = long_row(df, names, {"n_missing": [f"count_if({g})" for g in gaps], "n_rows": ["count(*)" for _ in gaps]})
    share = F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows"))
    out = counted.select("column", "n_missing", share.alias("fraction"), F.round(100 * share, 2).alias("percent"))
    if only_missing:
        out = out.where(F.col("n_missing") > 0)
    return out.orderBy(F.desc("n_missing"), "column")


def schema_report(df: DataFrame) -> DataFrame:
    """``column, dtype, non_null, n_rows`` for every column."""
    return long_row(df, df.columns, {
        "dtype": [text_literal(t) for _, t in df.dtypes],
        "non_null": [f"count_if(NOT {missing_test(df, n)})" for n in df.columns],
        "n_rows": ["count(*)" for _ in df.columns],
    })


def value_ranges(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, min, max`` of the numeric columns, as doubles."""
    return long_numbers(df, columns or numeric_columns(df)).groupBy("column").agg(F.min("x").alias("min"), F.max("x").alias("max"))


def skew_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, skewness`` (bias-corrected) of the numeric columns that have values."""
    return long_numbers(df, columns or numeric_columns(df)).groupBy("column").agg(corrected_skewness(F.col("x")).alias("skewness"))


def category_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, value, n`` for the labels of every text column, in one job.

    The count is combined map-side, so a label that fills a third of the table
    reaches the shuffle as one row per task.
    """
    names = columns or text_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    labels = stacked(df, names, "string").withColumnRenamed("x", "value").where("value IS NOT NULL")
    return labels.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def label_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``category_counts`` plus each label's share of the column's present values."""
    counts = category_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(  # one row for each column asked for
        "column", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per text column, ties to the smallest; one row per column reaches the driver."""
    if not columns:
        return {}
    top = category_counts(df, columns).groupBy("column").agg(mode_smallest(F.col("value"), F.col("n")).alias("mode"))
    found = {r["column"]: r["mode"] for r in top.collect()}
    return {n: found.get(n) for n in columns}


DESCRIBE_SCHEMA = (
    "column string, count long, unique long, top string, freq long, mean double, std double, min double, "
    "p25 double, p50 double, p75 double, max double"
)


def likely_large(df: DataFrame, direct_limit: int) -> bool:
    """Does the optimizer expect more rows than one task may hold? Decides only what is computed ahead, never a result."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > 8 * direct_limit


def describe_all(df: DataFrame, columns: list[str] | None = None, direct_limit: int = DIRECT_LIMIT) -> DataFrame:
    """Summary of every numeric and text column.

    ``column, count, unique, top, freq, mean, std, min, p25, p50, p75, max``;
    label statistics are NULL for numbers, number statistics for labels. The numbers of a large table are read twice: once for the plain
    statistics together with the sketch that starts the search for quartiles, once for the search.
    """
    wanted = set(columns or df.columns)
    numbers = [n for n in numeric_columns(df) if n in wanted]
    labels = [n for n in text_columns(df) if n in wanted]
    spark = df.sparkSession
    parts = []
    if numbers:
        x = F.col("x")
        ahead = {"grid": sketch_expression("x")} if likely_large(df, direct_limit) else {}
        basic = per_column(df, numbers, count=F.count(x), mean=F.avg(x), std=F.stddev_samp(x), min=F.min(x), max=F.max(x), **ahead)
        quartiles = column_quantiles(
            df, {n: [0.25, 0.5, 0.75] for n in numbers}, {n: basic[n]["count"] if n in basic else 0 for n in numbers}, direct_limit,
            sketches={n: r["grid"] for n, r in basic.items()} if ahead else None)
        rows = []
        for n in numbers:
            r = basic.get(n) or dict.fromkeys(("mean", "std", "min", "max")) | {"count": 0}
            rows.append((n, r["count"], None, None, None, r["mean"], r["std"], r["min"], *quartiles[n], r["max"]))
        parts.append(spark.createDataFrame(rows, DESCRIBE_SCHEMA))
    if labels:
        none = F.lit(None).cast("double")
        seen = category_counts(df, labels).groupBy("column").agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("t"),
        )
        seen = spark.createDataFrame([(n,) for n in labels], "column string").join(seen, "column", "left")
        parts.append(seen.select(
            "column", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("unique", F.lit(0)).alias("unique"),
            F.col("t.v").alias("top"), (-F.col("t.n")).alias("freq"),
            *[none.alias(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")],
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """``count, mean, median, std, min, p25, p75, max`` of one column."""
    q = column_quantiles(df, {target: [0.25, 0.5, 0.75]})[target]
    x = number(c(target))
    return df.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.lit(q[1]).cast("double").alias("median"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.lit(q[0]).cast("double").alias("p25"),
        F.lit(q[2]).cast("double").alias("p75"), F.max(x).alias("max"),
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """``n_rows, fingerprint``: the same for any row order and any partitioning."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_hash([c(n) for n in df.columns]).cast("decimal(38,0)")).cast("string").alias("fingerprint"),
    )
