"""The housing table as a client of the generic operators: contracts and derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.names import c
from ..functions.scalar import clip_low, differs_flag, positive_flag, ratio_or_zero
from .contracts import Check, ColumnRule, Contract, above, at_least, at_most, below, between, one_of

RAW_CONTRACT = Contract("raw homes", (
    ColumnRule("SalePrice", "double", False, (above(0), below(2_000_000))),
    ColumnRule("Gr Liv Area", "double", False, (above(0),)),
    ColumnRule("Overall Qual", "double", False, (between(1, 10),)),
    ColumnRule("Overall Cond", "double", False, (between(1, 10),)),
    ColumnRule("Year Built", "long", False, (at_least(1800), at_most(2025))),
    ColumnRule("Yr Sold", "long", False, (one_of([2006, 2007, 2008, 2009, 2010]),)),
    ColumnRule("Mo Sold", "long", False, (one_of(list(range(1, 13))),)),
    ColumnRule("Lot Area", "double", True, (above(0),)),
    ColumnRule("Garage Cars", "double", True, (between(0, 10),)),
    ColumnRule("Garage Area", "double", True, (at_least(0),)),
    ColumnRule("Total Bsmt SF", "double", True, (at_least(0),)),
    ColumnRule("MS Zoning", "string", True),
    ColumnRule("Sale Condition", "string", True),
))

PROCESSED_CONTRACT = Contract("processed homes", (
    ColumnRule("SalePrice", "double", False, (above(0),)),
    ColumnRule("Overall Qual", "double", False),
    ColumnRule("Gr Liv Area", "double", False),
))

_BOUND = {">": above, ">=": at_least, "<": below, "<=": at_most}


def _request_checks(low: str | None, high: str | None) -> list[Check]:
    out = []
    for bound in (low, high):
        if bound:
            sign, number = bound.split()
            out.append(_BOUND[sign](float(number) if "." in number else int(number)))
    return out


def request_contract() -> Contract:
    """Field rules of a scoring request; optional fields may be absent or missing."""
    rules = []
    for name, _, dtype, default, low, high in fixed.REQUEST_FIELDS:
        checks = _request_checks(low, high)
        if name in fixed.QUALITY_FIELDS:
            checks.append(one_of(fixed.QUALITY_LABELS))
        needed = default is fixed.REQUIRED
        rules.append(ColumnRule(name, dtype, not needed, tuple(checks), needed))
    return Contract("scoring request", tuple(rules))


def derived_features(df: DataFrame) -> dict[str, Column]:
    """The 13 derived features, by name; a source column that is absent counts as 0."""
    have = set(df.columns)

    def x(name: str) -> Column:
        return c(name) if name in have else F.lit(0)

    # fixed values: the published formulas, in their order
    return {
        "TotalSF": x("Total Bsmt SF") + x("1st Flr SF") + x("2nd Flr SF"),
        "TotalBath": x("Full Bath") + 0.5 * x("Half Bath") + x("Bsmt Full Bath") + 0.5 * x("Bsmt Half Bath"),
        "PorchSF": x("Open Porch SF") + x("Enclosed Porch") + x("3Ssn Porch") + x("Screen Porch"),
        "HouseAge": clip_low(x("Yr Sold") - x("Year Built")),
        "RemodelAge": clip_low(x("Yr Sold") - x("Year Remod/Add")),
        "IsRemodeled": differs_flag(x("Year Built"), x("Year Remod/Add")),
        "QualCond": x("Overall Qual") * x("Overall Cond"),
        "GarageScore": x("Garage Cars") * x("Garage Area"),
        "HasPool": positive_flag(x("Pool Area")),
        "HasFireplace": positive_flag(x("Fireplaces")),
        "HasGarage": positive_flag(x("Garage Area")),
        "HasBasement": positive_flag(x("Total Bsmt SF")),
        "LotToLivRatio": ratio_or_zero(x("Lot Area"), x("Gr Liv Area")),
    }


def add_features(df: DataFrame) -> DataFrame:
    """Append the derived features; nothing is dropped."""
    return df.withColumns(derived_features(df))
