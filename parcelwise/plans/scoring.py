"""Scoring of request tables of any size: validate, default, rename, predict, band, stamp."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.names import c
from ..functions.scalar import relative_band
from ..operators.contracts import annotate
from ..operators.housing import request_contract
from ..sources.requests import canonical_names, merge_spelled, with_defaults

REASONS = "reasons"


def check_requests(df: DataFrame) -> DataFrame:
    """Requests with a ``reasons`` array, empty for valid ones."""
    return annotate(merge_spelled(df), request_contract(), REASONS)


def valid_inputs(checked: DataFrame) -> DataFrame:
    """Valid requests, defaults filled, under the table's column names."""
    return canonical_names(with_defaults(checked.where(F.size(REASONS) == 0).drop(REASONS)))


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)


def prediction_id(run: str, keys: list[Column]) -> Column:
    """An id in UUID form from the run and the row's key: the same however often the row is scored in that run.

    Each part carries its length, so no two keys have one form; rows that share a key share the id.
    """
    parts = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit("="), x), F.lit("~")) for x in (F.lit(run), *[k.cast("string") for k in keys])]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])


def price_columns(
    scored: DataFrame, keep: list[str], log_target: bool = True, band: float = fixed.BAND_WIDTH, version: str = fixed.MODEL_VERSION,
    prediction: str = "prediction", stamp: bool = True, run: str | None = None, at: datetime | None = None,
) -> DataFrame:
    """``keep..., predicted_price, lower_bound, upper_bound, model_version[, prediction_id, timestamp]``.

    With ``run``, ids follow from it and the columns kept, which must tell rows apart, and ``at`` is the time: a repeated job gives the
    same stamps. Without it ids are random.
    """
    price = F.expm1(c(prediction)) if log_target else c(prediction)
    low, high = relative_band(price, band)
    time = F.current_timestamp() if at is None else F.lit(at)
    made = F.expr("uuid()") if run is None else prediction_id(run, [c(k) for k in keep])
    stamps = [made.alias("prediction_id"), time.alias("timestamp")] if stamp else []
    return scored.select(
        *[c(k) for k in keep], F.round(price, 2).alias("predicted_price"), F.round(low, 2).alias("lower_bound"),
        F.round(high, 2).alias("upper_bound"), F.lit(version).alias("model_version"), *stamps)


def score(model: PipelineModel, requests: DataFrame, keep: list[str], **options) -> tuple[DataFrame, DataFrame]:
    """``(scored valid requests, quarantined requests with reasons)``."""
    checked = check_requests(requests)
    return price_columns(model.transform(valid_inputs(checked)), keep, **options), quarantined(checked)
