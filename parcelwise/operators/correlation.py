"""Pairwise-complete Pearson correlations."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F

from ..functions.names import number_literal, numeric_columns, per_column, quote, stacked
from ..functions.stats import pairwise_correlation

PAIR_SCHEMA = "x string, y string, corr double"


def _second_moments(vectors: DataFrame) -> np.ndarray:
    """E[v vT] of the vector column ``v``, from its means, variances and correlations."""
    s = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).select("s.*").head()
    n, mean, spread = s["count"], s["mean"].toArray(), np.sqrt(s["variance"].toArray())
    corr = np.nan_to_num(Correlation.corr(vectors, "v").head()[0].toArray())  # NaN beside a constant slot
    np.fill_diagonal(corr, 1.0)
    return corr * np.outer(spread, spread) * (n - 1) / n + np.outer(mean, mean)


def correlation_array(df: DataFrame, names: list[str]) -> np.ndarray:
    """Correlations of every pair over the rows where both are present; NaN where one is constant there.

    Values are centred and scaled first. Beside each value ``z`` the vector
    holds its square ``q`` and, for columns with gaps, a presence mask ``m``
    (one shared constant slot for the others), so its second moments contain
    every pairwise count, sum, square sum and product sum. A fixed number of
    passes does for any number of columns, and only moments reach the driver.
    """
    base = per_column(df, names, n=F.count("x"), mean=F.avg("x"), spread=F.stddev_pop("x"))
    total = df.count()
    values, squares, masks, mask_name = [], [], [], {}
    for i, name in enumerate(names):
        s = base.get(name) or {"n": 0, "mean": 0.0, "spread": 1.0}
        x = f"nullif(CAST({quote(name)} AS double), double('NaN'))"
        values.append(f"coalesce(({x} - {number_literal(s['mean'])}) / {number_literal(s['spread'] or 1.0)}, 0D) AS z{i}")
        squares.append(f"z{i} * z{i} AS q{i}")
        mask_name[i] = f"m{i}" if s["n"] < total else "one"
        if s["n"] < total:
            masks.append(f"CAST({x} IS NOT NULL AS double) AS m{i}")
    flat = df.selectExpr(*values, *masks, "1D AS one").selectExpr(*[f"z{i}" for i in range(len(names))], *squares, *[m.split()[-1] for m in masks], "one")
    vectors = VectorAssembler(inputCols=flat.columns, outputCol="v").transform(flat).select("v")
    moments = _second_moments(vectors)
    at = {n: i for i, n in enumerate(flat.columns)}
    p = len(names)
    mask = [at[mask_name[i]] for i in range(p)]
    n = moments[np.ix_(mask, mask)]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = moments[:p][:, mask] / n                         # mean of i where j is present
        var = moments[p:2 * p][:, mask] / n - mean ** 2
        cov = moments[:p, :p] / n - mean * mean.T
        corr = cov / np.sqrt(var * var.T)
    corr[(var < 1e-12) | (var.T < 1e-12)] = np.nan
    return np.clip(corr, -1.0, 1.0)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``x, y, corr`` for every ordered pair, the diagonal included (NULL for a constant column)."""
    names = columns or numeric_columns(df)
    found = correlation_array(df, names)
    rows = [
        (a, b, None if np.isnan(found[i, j]) else 1.0 if i == j else float(found[i, j]))
        for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, PAIR_SCHEMA)


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``x, y, corr`` for each unordered pair of distinct columns."""
    names = columns or numeric_columns(df)
    order = F.array(*[F.lit(n) for n in names])
    return correlation_matrix(df, names).where(F.array_position(order, F.col("x")) < F.array_position(order, F.col("y")))


def target_correlations(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """``column, corr`` with the target for every other numeric column, stacked into one small aggregation."""
    names = columns or numeric_columns(df, exclude=[target])
    pairs = stacked(df, names, "double", (f"CAST({quote(target)} AS double) AS __target",))
    return pairs.groupBy("column").agg(pairwise_correlation(F.col("x"), F.col("__target")).alias("corr"))


def top_correlations(df: DataFrame, target: str, k: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The k columns that go most strongly up with the target, highest first."""
    return target_correlations(df, target, columns).where(F.col("corr").isNotNull()).orderBy(F.desc("corr"), "column").limit(k)


def top_correlation_matrix(df: DataFrame, target: str, k: int = 10, columns: list[str] | None = None) -> DataFrame:
    """Correlations among the k columns of ``top_correlations`` (heat-map data)."""
    leaders = [r["column"] for r in top_correlations(df, target, k, columns).collect()]
    return correlation_matrix(df, leaders)
