"""Lenient reading of headed CSV: good rows load, bad ones come back with their file and what is wrong with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fixed
from ..functions.names import c, quote, text_literal
from .tabular import _read

_RECORD, _FILE = "__record", "__file"
_RAGGED = "as many cells as the header"


def _lenient(spark: SparkSession, path: str, null_tokens: list[str], **options) -> tuple[DataFrame, list[str]]:
    """All rows with their cells as text, missing tokens as NULL; a row that does not fit the header also with its record."""
    names = _read(spark.read.option("header", True).options(**options), "csv", path, "Raw data").columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    reader = spark.read.schema(schema).option("header", True).options(
        **{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD, "columnPruning": "false"} | options)
    rows = reader.csv(path).withColumn(_FILE, F.col("_metadata.file_path"))
    tokens = ", ".join(map(text_literal, null_tokens))
    cells = [f"CASE WHEN {quote(_RECORD)} IS NULL AND trim({quote(n)}) NOT IN ({tokens}) THEN {quote(n)} END AS {quote(n)}" for n in names]
    return rows.selectExpr(*cells, quote(_RECORD), quote(_FILE)), names


def read_csv_with_quarantine(
    spark: SparkSession, path: str, schema: T.StructType, null_tokens: list[str] = fixed.NULL_TOKENS, **options,
) -> tuple[DataFrame, DataFrame]:
    """``(rows in their types, quarantined rows)`` of a headed CSV; nothing fails because of a row.

    A row is quarantined when it has more or fewer cells than the header, or a present cell that is not of the type that ``schema`` gives
    its column. Quarantined rows are ``file, record, reasons``: the record as it stands in the file for a ragged row, the cells put
    together again for one with bad cells; a reason is ``(column, check, value)`` as contracts report it. Columns that the
    schema does not name stay text; columns that the file lacks are NULL. Both results read the file by themselves.
    """
    rows, names = _lenient(spark, path, null_tokens, **options)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    none = "CAST(NULL AS string)"
    found = [f"CASE WHEN {quote(_RECORD)} IS NOT NULL THEN named_struct('column', {none}, 'check', {text_literal(_RAGGED)}, 'value', {none}) END"]
    for n in names:
        kind = kinds.get(n, "string")
        if kind != "string":
            found.append(
                f"CASE WHEN {quote(n)} IS NOT NULL AND try_cast(trim({quote(n)}) AS {kind}) IS NULL "
                f"THEN named_struct('column', {text_literal(n)}, 'check', {text_literal('is ' + kind)}, 'value', {quote(n)}) END")
    judged = rows.selectExpr("*", f"array_compact(array({', '.join(found)})) AS __reasons")
    typed = [f"try_cast(trim({quote(n)}) AS {kinds[n]}) AS {quote(n)}" if kinds.get(n, "string") != "string" else quote(n) for n in names]
    absent = [f"CAST(NULL AS {t}) AS {quote(n)}" for n, t in kinds.items() if n not in names]
    good = judged.where("size(__reasons) = 0").selectExpr(*typed, *absent)
    put_together = F.to_csv(F.struct(*[c(n) for n in names]))
    bad = judged.where("size(__reasons) > 0").select(F.col(_FILE).alias("file"), F.coalesce(c(_RECORD), put_together).alias("record"), F.col("__reasons").alias("reasons"))
    return good, bad
