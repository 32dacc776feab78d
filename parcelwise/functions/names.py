"""Column names: quoting, selection by type, and the aggregation shapes shared by the operators.

Expressions over many columns are written as SQL text: one parsed string per
column costs the driver far less than the same tree built call by call.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str | None) -> str:
    """A string as a SQL literal."""
    return "cast(null as string)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number_literal(value: float) -> str:
    """A number as a SQL double literal that keeps every digit."""
    return f"{float(value)!r}D"


def c(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col(quote(name))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def replace_columns(df: DataFrame, changed: dict[str, str]) -> DataFrame:
    """The same columns in the same order, some of them computed by SQL text."""
    return df.selectExpr(*[f"{changed[n]} AS {quote(n)}" if n in changed else quote(n) for n in df.columns]) if changed else df


def stacked(df: DataFrame, names: list[str], kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep..., column, x``: several columns under each other, cast to one type."""
    pairs = ", ".join(f"{text_literal(n)}, CAST({quote(n)} AS {kind})" for n in names)
    return df.selectExpr(*keep, f"stack({len(names)}, {pairs}) AS (column, x)")


def long_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    """``column, x``: the present numbers of several columns stacked, as doubles.

    Grouping this by ``column`` keeps the generated aggregation code small
    however wide the table is, and spreads the columns over the reducers;
    rows are combined map-side, so the shuffle carries one buffer per column
    and task.
    """
    return stacked(df, names, "double").where("x IS NOT NULL AND NOT isnan(x)")


def per_column(df: DataFrame, names: list[str], **aggregates: Column) -> dict[str, dict]:
    """Aggregates of ``x`` for each column, collected: one small row per column. Columns without values are left out."""
    if not names:
        return {}
    rows = long_numbers(df, names).groupBy("column").agg(*[a.alias(k) for k, a in aggregates.items()]).collect()
    return {r["column"]: r.asDict() for r in rows}


def long_row(df: DataFrame, columns: list[str], fields: dict[str, list[str]]) -> DataFrame:
    """One global aggregation laid out as one row per column.

    ``fields[name][i]`` is the aggregate called ``name`` for ``columns[i]``, as SQL text.
    """
    rows = ", ".join(
        "named_struct('column', " + text_literal(n) + "".join(f", {text_literal(f)}, {values[i]}" for f, values in fields.items()) + ")"
        for i, n in enumerate(columns)
    )
    return df.selectExpr(f"array({rows}) AS rows").selectExpr("inline(rows)")
