"""Scoring requests: schema, JSON reader, defaults and canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fixed
from ..functions.names import c, present, quote, text_literal

# Two fields start with a digit and may also come under a spelled-out name.
SPELLED = {"FirstFlrSF": "1stFlrSF", "SecondFlrSF": "2ndFlrSF"}


def request_schema(extra: dict[str, str] | None = None) -> T.StructType:
    """All fields as text, so that a badly typed value reaches the contract instead of turning into NULL."""
    names = [f[0] for f in fixed.REQUEST_FIELDS] + list(SPELLED)
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in (extra or {}).items()] + fields)


def merge_spelled(df: DataFrame) -> DataFrame:
    """Fold the spelled-out field names into the canonical field names."""
    for spelled, field in SPELLED.items():
        if spelled in df.columns:
            df = df.withColumn(field, F.coalesce(c(field), c(spelled))) if field in df.columns else df.withColumnRenamed(spelled, field)
            df = df.drop(spelled)
    return df


def read_requests(spark: SparkSession, path: str, extra: dict[str, str] | None = None) -> DataFrame:
    return merge_spelled(spark.read.schema(request_schema(extra)).json(path))


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill optional fields with their defaults, constant or copied; absent fields are added."""
    have = set(df.columns)

    def given(name: str, dtype: str) -> str:
        if name not in have:
            return f"CAST(NULL AS {dtype})"
        x = f"try_cast({quote(name)} AS {dtype})"
        return f"coalesce({x}, try_cast(try_cast({quote(name)} AS double) AS int))" if dtype == "int" else x

    kinds = {f[0]: f[2] for f in fixed.REQUEST_FIELDS}
    filled = {}
    for name, _, dtype, default, _, _ in fixed.REQUEST_FIELDS:
        if default is fixed.REQUIRED:
            filled[name] = given(name, dtype)
        elif isinstance(default, str) and default.startswith("="):
            source = default[1:]
            filled[name] = f"coalesce({given(name, dtype)}, CAST({given(source, kinds[source])} AS {dtype}))"
        else:
            value = text_literal(default) if isinstance(default, str) else str(default)
            filled[name] = f"coalesce({given(name, dtype)}, CAST({value} AS {dtype}))"
    return df.selectExpr(*[quote(n) for n in df.columns if n not in filled], *[f"{x} AS {quote(n)}" for n, x in filled.items()])


def canonical_names(df: DataFrame) -> DataFrame:
    """Request field names to the table's column names."""
    return df.withColumnsRenamed({f[0]: f[1] for f in fixed.REQUEST_FIELDS if f[0] in set(df.columns)})


def request_columns(df: DataFrame) -> list[str]:
    return present(df, [f[0] for f in fixed.REQUEST_FIELDS])
