"""The whole-table preparation plan: raw rows to encoded, split rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..functions.names import c, numeric_columns, text_columns
from ..operators import clean, encode, label_numbers, split
from ..operators.contracts import Contract, enforce
from ..operators.housing import PROCESSED_CONTRACT, RAW_CONTRACT
from ..operators.order_stats import column_quantiles
from ..operators.profile import missing_counts
from ..session import written
from ..sources import versions
from ..sources.tabular import load_raw, read_feature_names, read_split, write_feature_names, write_splits


@dataclass(frozen=True)
class Options:
    target: str = fixed.TARGET
    key: str = "PID"
    ids: tuple[str, ...] = tuple(fixed.ID_COLUMNS)
    missing_threshold: float = fixed.MISSING_THRESHOLD
    skew_threshold: float = fixed.SKEW_THRESHOLD
    numeric_fill: str = "median"
    remove_outliers: bool = True
    log_target: bool = True
    test_size: float = fixed.TEST_SIZE
    val_size: float = fixed.VAL_SIZE
    seed: int = fixed.SEED
    exact_split: bool = True


@dataclass(frozen=True)
class Prepared:
    """The prepared table (lazy) and every decision taken on the way."""

    table: DataFrame
    dropped: list[str] = field(default_factory=list)
    fill: clean.Fill = field(default_factory=clean.Fill)
    bounds: clean.Bounds | None = None
    skewed: list[str] = field(default_factory=list)
    indicators: encode.Indicators = field(default_factory=encode.Indicators)
    features: list[str] = field(default_factory=list)
    dictionary: DataFrame | None = None  # numbers of the labels in the ``label_numbers`` column, if there is one


def prepare(raw: DataFrame, options: Options = Options()) -> Prepared:
    """Drop sparse, fill, drop outliers, log, encode, split; statistics come from the whole table.

    Each step is a projection over the raw scan, so a statistics pass reads
    only the columns it needs and nothing is materialised between steps. Text columns with more labels than a table should
    have columns are not spread out: an array column ``label_numbers`` holds their labels' numbers in ``Prepared.dictionary``.
    """
    o = options
    if o.key not in raw.columns:
        raise ValueError(f"key column {o.key!r} is missing; name a unique column")
    df = raw.drop(*[i for i in o.ids if i != o.key])
    body = [n for n in df.columns if n != o.key]
    n_rows, gaps = missing_counts(df, body)
    dropped = [n for n in body if n_rows and gaps[n] / n_rows > o.missing_threshold]
    df = df.drop(*dropped)
    kept = [n for n in body if n not in dropped]
    gapped = [n for n in kept if gaps[n]]
    quartiles = None
    if o.numeric_fill == "median":
        # medians of the gapped columns and, where filling cannot move them, the target's quartiles in one pass
        wanted = {n: [0.5] for n in numeric_columns(df) if n in set(gapped)}
        if o.remove_outliers and o.target not in gapped:
            wanted[o.target] = [0.25, 0.75]
        found = column_quantiles(df, wanted, {n: n_rows - gaps[n] for n in wanted})
        quartiles = found.pop(o.target, None) if o.target not in gapped else None
        values = {n: q[0] for n, q in found.items()} | clean.modes(df, [n for n in text_columns(df) if n in set(gapped)])
        fill = clean.Fill({n: v for n, v in values.items() if v is not None})
    else:
        fill = clean.fit_fill(df, o.numeric_fill, columns=gapped, gaps=(n_rows, gaps))
    df = clean.apply_fill(df, fill)
    bounds = None
    if o.remove_outliers:
        q1, q3 = quartiles or column_quantiles(df, {o.target: [0.25, 0.75]}, {o.target: n_rows})[o.target]
        reach = fixed.IQR_FACTOR * (q3 - q1)
        bounds = clean.Bounds(o.target, q1 - reach, q3 + reach)
        df = clean.apply_bounds(df, bounds)
    if o.log_target:
        df = df.withColumn(o.target, F.log1p(c(o.target)))
    skewed = encode.skewed_columns(df, o.skew_threshold, [o.target, o.key])
    df = encode.log_columns(df, skewed)
    indicators = encode.fit_indicators(df, [n for n in text_columns(df) if n != o.key])
    df = encode.apply_indicators(df, indicators)
    features = [n for n in numeric_columns(df) if n not in (o.key, o.target)]
    dictionary, extra = None, []
    if indicators.wide:
        dictionary = label_numbers.fit_dictionary(df, list(indicators.wide))
        df = label_numbers.label_numbers(df, list(indicators.wide), dictionary)
        extra = [F.array_compact(F.array(*[c(n) for n in sorted(indicators.wide)])).alias("label_numbers")]
    df = df.select(c(o.key), *[c(n) for n in features], *extra, c(o.target))
    table = split.split_by_target(
        df, o.key, o.target, at_most=n_rows, test_size=o.test_size, val_size=o.val_size, seed=o.seed, exact=o.exact_split)
    return Prepared(table, dropped, fill, bounds, skewed, indicators, features, dictionary)


def run(
    spark: SparkSession, raw_path: str, out_path: str, options: Options = Options(), schema=None, contract: Contract = RAW_CONTRACT,
    processed: Contract = PROCESSED_CONTRACT,
) -> Prepared:
    """CSV to written splits with the raw and processed contracts enforced.

    Splits and feature names are one version of ``out_path``: readers (``read_prepared_split``) see both or neither.
    """
    raw = written(load_raw(spark, raw_path, contract, schema=schema), "raw")  # every statistic reads columns instead of parsing text
    done = prepare(raw, options)
    enforce(done.table, processed)
    table = done.table.drop(options.key) if options.key in options.ids else done.table
    parts = {"splits": lambda path: write_splits(table, path), "feature_names": lambda path: write_feature_names(spark, done.features, path)}
    if done.dictionary is not None:
        parts["dictionary"] = lambda path: done.dictionary.write.parquet(path)
    versions.write_version(spark, out_path, parts)
    return done


def read_prepared_split(spark: SparkSession, out_path: str, split: str = "train") -> DataFrame:
    """One split of the current version."""
    return read_split(spark, versions.part_path(spark, out_path, "splits"), split)


def read_prepared_names(spark: SparkSession, out_path: str) -> list[str]:
    return read_feature_names(spark, versions.part_path(spark, out_path, "feature_names"))
