"""Encoders: skew correction, rare labels, one-hot, scaling. Fit once, apply anywhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.names import c, number_literal, numeric_columns, per_column, present, quote, replace_columns, text_columns, text_literal
from ..functions.stats import corrected_skewness
from ..session import reliable
from . import label_numbers
from .profile import category_counts, label_shares

LITERAL_LABELS = 1_000   # labels held in an expression; more are joined
WIDE_LABELS = 2_000      # indicator columns one table may get; columns with more go to a sparse vector
BROADCAST_LABELS = 100_000  # kept labels that are sent to every task
VECTOR_LABELS = 100_000  # labels the driver may hold; more are encoded by a dictionary table


# --- skew ------------------------------------------------------------------

def skewed_columns(df: DataFrame, threshold: float = fixed.SKEW_THRESHOLD, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns with absolute corrected skewness above the threshold, in name order."""
    names = sorted(numeric_columns(df, exclude or []))
    skew = {n: r["g1"] for n, r in per_column(df, names, g1=corrected_skewness(F.col("x"))).items()}
    return [n for n in names if skew.get(n) is not None and abs(skew[n]) > threshold]


def log_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``log1p(max(x, 0))`` on the columns that are present."""
    return replace_columns(df, {
        n: f"log1p(CASE WHEN {q} < 0 THEN 0D ELSE CAST({q} AS double) END)" for n, q in ((n, quote(n)) for n in present(df, columns))})


# --- rare labels -----------------------------------------------------------

@dataclass(frozen=True)
class FrequentLabels:
    """Labels kept per column: a few as lists, more as a table ``column, value``."""

    labels: dict = field(default_factory=dict)
    other: str = fixed.RARE_LABEL
    table: DataFrame | None = None


def frequent_label_table(df: DataFrame, threshold: float, columns: list[str] | None = None) -> DataFrame:
    return label_shares(df, columns).where(F.col("share") >= threshold).select("column", "value")


def fit_frequent_labels(
    df: DataFrame, threshold: float = fixed.RARE_THRESHOLD, other: str = fixed.RARE_LABEL, columns: list[str] | None = None,
) -> FrequentLabels:
    """Labels holding at least ``threshold`` of a column's present values.

    ``1/threshold`` bounds the labels of a column. Up to ``LITERAL_LABELS`` of them reach the driver; where more could pass they stay a
    table and are joined.
    """
    names = columns or text_columns(df)
    if threshold * LITERAL_LABELS < 1:
        return FrequentLabels(dict.fromkeys(names, ()), other, label_numbers.frequent_table(df, threshold, names))
    kept: dict[str, list[str]] = {n: [] for n in names}
    for row in frequent_label_table(df, threshold, names).collect():
        kept[row["column"]].append(row["value"])
    return FrequentLabels({n: sorted(v) for n, v in kept.items()}, other)


def apply_frequent_labels(df: DataFrame, fitted: FrequentLabels) -> DataFrame:
    """Anything not kept becomes the other label: rare, unseen and missing values alike."""
    if fitted.table is not None:
        return label_numbers.keep_frequent(df, present(df, fitted.labels), fitted.table, fitted.other)
    changed = {}
    for n in present(df, fitted.labels):
        kept, other = ", ".join(map(text_literal, fitted.labels[n])), text_literal(fitted.other)
        changed[n] = f"CASE WHEN {quote(n)} IN ({kept}) THEN {quote(n)} ELSE {other} END" if kept else other
    return replace_columns(df, changed)


def collapse_rare_labels(df: DataFrame, threshold: float, column: str, other: str = fixed.RARE_LABEL) -> DataFrame:
    """The same for one column with any number of kept labels, by a join with the label table.

    At most ``1/threshold`` labels can be kept. Up to ``BROADCAST_LABELS`` they are sent to the tasks, so a hot label moves
    no rows; beyond that the join is left to Spark.
    """
    keep = frequent_label_table(df, threshold, [column]).select(F.col("value").alias("__keep"))
    if threshold * BROADCAST_LABELS >= 1:
        keep = F.broadcast(keep)
    return df.join(keep, c(column) == F.col("__keep"), "left").select(
        *[F.coalesce("__keep", F.lit(other)).alias(n) if n == column else c(n) for n in df.columns])


# --- one-hot ---------------------------------------------------------------

def counted_labels(df: DataFrame, columns: list[str], limit: int = VECTOR_LABELS) -> dict[str, dict[str, int]] | None:
    """Counts per label and column, or None if there are more labels than the driver should hold (``label_numbers`` takes any number)."""
    rows = category_counts(df, columns).limit(limit + 1).collect() if columns else []
    if len(rows) > limit:
        return None
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["column"], {})[r["value"]] = r["n"]
    return out


@dataclass(frozen=True)
class Indicators:
    """Sorted labels per column, one 0/1 column each; ``wide`` columns have more labels than a table should have columns."""

    labels: dict = field(default_factory=dict)
    wide: tuple = ()

    def names(self, column: str) -> list[str]:
        return [f"{column}_{v}" for v in self.labels[column]]


def fit_indicators(df: DataFrame, columns: list[str] | None = None, limit: int = WIDE_LABELS) -> Indicators:
    """Learn the labels, sorted within each column.

    Columns are taken in order while all indicators together stay within ``limit``; a table has no room for the labels of the others,
    which are listed as ``wide`` and belong in a sparse vector (``label_numbers``).
    """
    names = columns or text_columns(df)
    if not names:
        return Indicators({})
    counts = reliable(category_counts(df, names))
    sizes = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    room, wide = limit, []
    for n in names:
        if sizes.get(n, 0) <= room:
            room -= sizes.get(n, 0)
        else:
            wide.append(n)
    labels: dict[str, list[str]] = {n: [] for n in names if n not in wide}
    for r in counts.where(F.col("column").isin(list(labels))).select("column", "value").collect():
        labels[r["column"]].append(r["value"])
    return Indicators({n: sorted(v) for n, v in labels.items()}, tuple(wide))


def apply_indicators(df: DataFrame, fitted: Indicators) -> DataFrame:
    """Replace each column with its indicator columns, appended in label order; missing and unseen give zeros."""
    flags = []
    for n in present(df, fitted.labels):
        flags += [
            f"CASE WHEN {quote(n)} = {text_literal(v)} THEN 1D ELSE 0D END AS {quote(name)}"
            for v, name in zip(fitted.labels[n], fitted.names(n))
        ]
    return df.selectExpr(*[quote(n) for n in df.columns if n not in fitted.labels], *flags)


def melt_indicators(df: DataFrame, prefix: str, keep: list[str], label: str) -> DataFrame:
    """Undo one-hot: ``keep..., label`` with the indicator name of each set flag.

    One array per row is filtered in place, so unset flags are never written out.
    """
    flags = [n for n in df.columns if n.startswith(prefix) and n not in keep]
    named = ", ".join(f"CASE WHEN {quote(n)} = 1 THEN {text_literal(n)} END" for n in flags)
    return df.selectExpr(*map(quote, keep), f"explode(array_compact(array({named}))) AS {quote(label)}")


# --- scaling ---------------------------------------------------------------

@dataclass(frozen=True)
class Scale:
    """Mean and population deviation per column; a constant column keeps divisor 1."""

    mean: dict = field(default_factory=dict)
    deviation: dict = field(default_factory=dict)


def fit_scale(df: DataFrame, columns: list[str] | None = None) -> Scale:
    names = columns or numeric_columns(df)
    found = per_column(df, names, mean=F.avg("x"), deviation=F.stddev_pop("x"), low=F.min("x"), high=F.max("x"))
    same = {n for n, r in found.items() if r["low"] == r["high"]}
    return Scale(
        {n: r["low"] if n in same else r["mean"] for n, r in found.items()}, {n: 1.0 if n in same else r["deviation"] or 1.0 for n, r in found.items()})


def apply_scale(df: DataFrame, fitted: Scale) -> DataFrame:
    return replace_columns(df, {
        n: f"((CAST({quote(n)} AS double) - {number_literal(fitted.mean[n])}) / {number_literal(fitted.deviation[n])})"
        for n in present(df, fitted.mean)})
