"""CSV in, Parquet splits out and in, JSON sidecars, and name normalisation."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fixed
from ..functions.names import c, present, quote, replace_columns, stacked, text_literal
from ..operators.contracts import Contract, enforce

SPLITS = ("train", "val", "test")
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_TRUTH = r"^(true|false|True|False|TRUE|FALSE)$"


def _read(reader, kind: str, path: str, hint: str) -> DataFrame:
    try:
        return getattr(reader, kind)(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"{hint} not found at {path!r}") from error
        raise


def infer_types(df: DataFrame) -> dict[str, str]:
    """Type per text column, from one aggregation over the whole table.

    Whole numbers become bigint if all of them fit, else decimal(38,0), else they stay text; then double, boolean, string.
    """
    x = F.trim("x")
    cells = stacked(df, df.columns, "string").where("x IS NOT NULL")
    found = cells.groupBy("column").agg(
        F.bool_and(x.rlike(_WHOLE)).alias("digits"), F.bool_and(x.rlike(_WHOLE) & F.expr("try_cast(trim(x) AS bigint) IS NOT NULL")).alias("whole"),
        F.bool_and(F.expr("try_cast(trim(x) AS decimal(38,0)) IS NOT NULL")).alias("wide"), F.bool_and(x.rlike(_NUMBER)).alias("number"), F.bool_and(x.rlike(_TRUTH)).alias("truth"))
    out = dict.fromkeys(df.columns, "string")
    for r in found.collect():
        out[r["column"]] = "bigint" if r["whole"] else ("decimal(38,0)" if r["wide"] else "string") if r["digits"] else "double" if r["number"] else "boolean" if r["truth"] else "string"
    return out


def read_text(spark: SparkSession, path: str, null_tokens: list[str] = fixed.NULL_TOKENS, **options) -> DataFrame:
    """All cells of a headed CSV as text, missing tokens as NULL.

    A row with more or fewer cells than the header, or a file whose header differs from the first one's, fails the
    read; ``mode="PERMISSIVE"`` among the options turns that off.
    """
    strict = {"mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false"}
    text = _read(spark.read.option("header", True).options(**strict | options), "csv", path, "Raw data")
    tokens = ", ".join(map(text_literal, null_tokens))
    return replace_columns(text, {n: f"CASE WHEN trim({quote(n)}) NOT IN ({tokens}) THEN {quote(n)} END" for n in text.columns})


def _cast(text: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Text columns in their types; a present cell that has no such value fails the job."""
    have = set(text.columns)
    return replace_columns(text, {
        n: f"CASE WHEN {quote(n)} IS NULL OR try_cast(trim({quote(n)}) AS {t}) IS NOT NULL THEN try_cast(trim({quote(n)}) AS {t}) "
           f"ELSE raise_error(concat({text_literal(f'column {n} is not {t}: ')}, {quote(n)})) END"
        for n, t in kinds.items() if t != "string" and n in have})


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, null_tokens: list[str] = fixed.NULL_TOKENS, **options,
) -> DataFrame:
    """A headed CSV with several spellings of "missing".

    Cells are read as text, missing tokens become NULL, then columns are cast.
    Give ``schema`` for large inputs: without it one more pass finds the types.
    """
    text = read_text(spark, path, null_tokens, **options)
    return _cast(text, {f.name: f.dataType.simpleString() for f in schema} if schema else infer_types(text))


# --- names and labels ------------------------------------------------------

def ordinal_label(x: Column) -> Column:
    """Quality wording to 1..10, underscores read as spaces; anything else is NULL."""
    pairs = [F.lit(v) for item in fixed.ORDINAL_LABELS.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), F.translate(x, "_", " "))


def rename_columns(df: DataFrame) -> DataFrame:
    """Underscore names as spaced ones, extra coordinates dropped; the same table if no name holds an underscore."""
    if not any("_" in n for n in df.columns):
        return df
    spaced = [n.replace("_", " ") for n in df.columns]
    return df.toDF(*[fixed.NAME_OVERRIDES.get(n, n) for n in spaced]).drop(*fixed.EXTRA_COLUMNS)


def normalise_names(df: DataFrame) -> DataFrame:
    """Bring an underscore-named table to the canonical spaced names.

    Acts only if some name holds an underscore: renames, drops the extra
    coordinates and turns worded quality ratings into integers.
    """
    out = rename_columns(df)
    if out is df:
        return df
    worded = [n for n in present(out, fixed.ORDINAL_COLUMNS) if isinstance(out.schema[n].dataType, T.StringType)]
    return out.withColumns({n: ordinal_label(c(n)) for n in worded}) if worded else out


def unmapped_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, n_unmapped``: present wordings without a rating."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("column"), F.count_if(c(n).isNotNull() & ordinal_label(c(n)).isNull()).alias("n_unmapped"))
        for n in columns
    ])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def load_raw(spark: SparkSession, path: str, contract: Contract | None = None, schema: T.StructType | None = None, **options) -> DataFrame:
    """Read, normalise and check a raw table; raises with every broken rule and warns of ratings without a number.

    The contract sees the cells as they stand in the file, so a schema does not change what it finds; columns it does
    not name are cast by the schema or by inference.
    """
    text = read_text(spark, path, **options)
    spaced = rename_columns(text)
    worded = present(spaced, fixed.ORDINAL_COLUMNS) if any("_" in n for n in text.columns) else []
    if worded:
        lost = {r["column"]: r["n_unmapped"] for r in unmapped_labels(spaced, worded).collect() if r["n_unmapped"]}
        if lost:
            warnings.warn(f"ratings without a number became missing: {lost}", stacklevel=2)
    df = normalise_names(text)
    checked = enforce(df, contract) if contract else df
    declared = {r.column for r in contract.rules} if contract else set()
    left = [f.name for f in checked.schema if isinstance(f.dataType, T.StringType) and f.name not in declared]
    kinds = {f.name: f.dataType.simpleString() for f in schema} if schema else infer_types(checked.select(*map(c, left))) if left else {}
    return _cast(checked, {n: kinds[n] for n in left if n in kinds})


# --- splits ----------------------------------------------------------------

def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One Parquet dataset partitioned by split; a reader of one split opens only its folder."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    df = _read(spark.read, "parquet", path, f"Processed split {split!r}")
    df = df.where(F.col("split") == split)
    if df.isEmpty():  # opens that split's folder only
        raise FileNotFoundError(f"Processed split {split!r} not found at {path!r}")
    return df.drop("split")


# --- JSON sidecars ---------------------------------------------------------

def write_feature_names(spark: SparkSession, names: list[str], path: str) -> None:
    spark.createDataFrame([(names,)], "features array<string>").coalesce(1).write.mode("overwrite").json(path)


def read_feature_names(spark: SparkSession, path: str) -> list[str]:
    df = _read(spark.read.schema("features array<string>"), "json", path, "Feature names")
    return list(df.head()[0])
