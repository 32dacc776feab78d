"""Data contracts as rule tables: full violation reports, counts and quarantine.

Each rule becomes one element of an array column, so any number of rules costs
a single pass and no shuffle. Values are brought to the declared type with
``try_cast``; a value that cannot be is itself a violation. Value rules skip
missing values, which only the ``not_null`` rule reports.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.names import c, long_row, quote, replace_columns, text_literal
from .profile import missing_test

_FOUND = "__violations"
_ABSENT = "column exists"


class ContractError(ValueError):
    """A table broke its contract; the message lists violation counts per rule."""


@dataclass(frozen=True)
class Check:
    """A labelled condition on a present value, as SQL text about ``{x}``."""

    label: str
    condition: str


def above(low: float) -> Check:
    return Check(f"> {low}", f"{{x}} > {low}")


def below(high: float) -> Check:
    return Check(f"< {high}", f"{{x}} < {high}")


def at_least(low: float) -> Check:
    return Check(f">= {low}", f"{{x}} >= {low}")


def at_most(high: float) -> Check:
    return Check(f"<= {high}", f"{{x}} <= {high}")


def between(low: float, high: float) -> Check:
    return Check(f"in [{low}, {high}]", f"{{x}} BETWEEN {low} AND {high}")


def one_of(values: list) -> Check:
    listed = ", ".join(text_literal(v) if isinstance(v, str) else str(v) for v in values)
    return Check("one of " + ", ".join(map(str, values)), f"{{x}} IN ({listed})")


@dataclass(frozen=True)
class ColumnRule:
    """What one column must look like; ``dtype`` is double, long, int or string."""

    column: str
    dtype: str
    nullable: bool = True
    checks: tuple[Check, ...] = ()
    required: bool = True


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple[ColumnRule, ...] = field(default_factory=tuple)

    def only(self, columns: list[str]) -> Contract:
        return Contract(self.name, tuple(r for r in self.rules if r.column in set(columns)))

    def missing_columns(self, df: DataFrame) -> list[str]:
        have = set(df.columns)
        return [r.column for r in self.rules if r.required and r.column not in have]


def _typed(df: DataFrame, rule: ColumnRule) -> str:
    q, kind = quote(rule.column), df.schema[rule.column].dataType
    if rule.dtype == "double":
        return f"nullif(try_cast({q} AS double), double('NaN'))"
    if rule.dtype in ("int", "long") and isinstance(kind, T.StringType):
        whole = f"try_cast({q} AS double)"  # "7.0" is a whole number too; beyond 2**53 only digits will do
        return f"coalesce(try_cast({q} AS {rule.dtype}), try_cast(CASE WHEN {whole} = floor({whole}) THEN {whole} END AS {rule.dtype}))"
    if rule.dtype in ("int", "long") and isinstance(kind, (T.FractionalType, T.DecimalType)):
        return f"CASE WHEN {q} = floor({q}) THEN try_cast({q} AS {rule.dtype}) END"
    return f"try_cast({q} AS {rule.dtype})"


def _always_fits(kind: T.DataType, dtype: str) -> bool:
    """Does every value of the source type have one in the declared type?"""
    if dtype == "string":
        return True
    if dtype == "double":
        return isinstance(kind, T.NumericType)
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return isinstance(kind, small if dtype == "int" else (*small, T.LongType))


def _failures(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """``(column, check label, SQL condition of failure)`` for every rule on a column that is there."""
    have = set(df.columns)
    out = []
    for rule in contract.rules:
        if rule.column not in have:
            continue
        x, missing = _typed(df, rule), missing_test(df, rule.column)
        if not _always_fits(df.schema[rule.column].dataType, rule.dtype):
            out.append((rule.column, f"is {rule.dtype}", f"(NOT {missing} AND {x} IS NULL)"))
        if not rule.nullable:
            out.append((rule.column, "not null", missing))
        for check in rule.checks:
            out.append((rule.column, check.label, f"NOT coalesce({check.condition.format(x=x)}, true)"))
    return out


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """The table with every declared column cast to its type; values that cannot be become NULL."""
    return replace_columns(df, {r.column: _typed(df, r) for r in contract.rules if r.column in set(df.columns)})


def _found(name: str, label: str, value: str) -> str:
    return f"named_struct('column', {text_literal(name)}, 'check', {text_literal(label)}, 'value', {value})"


def annotate(df: DataFrame, contract: Contract, column: str = _FOUND) -> DataFrame:
    """Add an array of ``(column, check, value)`` structs, empty for a valid row."""
    found = [_found(n, _ABSENT, "CAST(NULL AS string)") for n in contract.missing_columns(df)] + [
        f"CASE WHEN {fails} THEN {_found(name, label, f'CAST({quote(name)} AS string)')} END"
        for name, label, fails in _failures(df, contract)
    ]
    return df.selectExpr("*", f"array_compact(array({', '.join(found)})) AS {quote(column)}")


def violations(df: DataFrame, contract: Contract, keys: list[str]) -> DataFrame:
    """``keys..., column, check, value``: one row per broken rule per row, all rules in one pass.

    A missing column is reported once, without keys.
    """
    present = contract.only(df.columns)
    found = annotate(df, present).where(F.size(_FOUND) > 0).select(*[c(k) for k in keys], F.inline(_FOUND))
    absent = contract.missing_columns(df)
    if not absent:
        return found
    rows = df.sparkSession.createDataFrame([(n, _ABSENT) for n in absent], "column string, check string")
    return found.unionByName(rows, allowMissingColumns=True)


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """``column, check, n`` for every rule, zero included, from one aggregation; a missing column counts once."""
    rules = [(n, _ABSENT, "1L") for n in contract.missing_columns(df)]
    rules += [(name, label, f"count_if({fails})") for name, label, fails in _failures(df, contract)]
    return long_row(df, [n for n, _, _ in rules], {"check": [text_literal(x) for _, x, _ in rules], "n": [n for _, _, n in rules]})


def split_valid(df: DataFrame, contract: Contract, reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """``(valid rows coerced to their types, quarantined rows as they came with their reasons)``."""
    if contract.missing_columns(df):
        ok = "false"
    else:
        ok = " AND ".join(f"NOT ({fails})" for _, _, fails in _failures(df, contract)) or "true"
    return coerce(df.where(ok), contract), annotate(df, contract, reasons).where(F.size(reasons) > 0)


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Return the coerced table, or raise with every broken rule and its count."""
    broken = [r for r in violation_counts(df, contract).collect() if r["n"] > 0]
    if broken:
        lines = [f"{r['column']}: not ({r['check']}) x {r['n']}" for r in broken]
        raise ContractError(f"contract {contract.name} broken:\n  " + "\n  ".join(lines))
    return coerce(df, contract)
