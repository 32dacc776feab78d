"""Scoring of requests as they arrive, with a quarantine for invalid ones.

Stateless. Each micro-batch overwrites its own folder in both sinks, so a
batch repeated after a failure replaces its output instead of adding to it, with the same ids: they follow from the run's name and
the request's key. A batch is entered in ``commits`` when both sinks are written; ``read_scored`` and ``read_quarantine`` show
entered batches only, so a half-written batch is never seen.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.scoring import check_requests, price_columns, quarantined, valid_inputs
from ..sources.requests import request_schema


def read_request_stream(spark: SparkSession, path: str, extra: dict[str, str] | None = None, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(request_schema(extra)).option("maxFilesPerTrigger", files_per_batch).json(path)


def start_scoring(
    requests: DataFrame, model: PipelineModel, out: str, checkpoint: str, keep: list[str], once: bool = False, **options,
) -> StreamingQuery:
    """Write ``out/scored`` and ``out/quarantine`` until stopped, or through the present input with ``once``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = check_requests(batch).persist(StorageLevel.MEMORY_AND_DISK)
        scored = price_columns(model.transform(valid_inputs(checked)), keep, **options)
        scored.write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
        quarantined(checked).write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
        batch.sparkSession.range(1).selectExpr(f"{batch_id}L AS batch").coalesce(1).write.mode("overwrite").parquet(f"{out}/commits/of={batch_id}")
        checked.unpersist()

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _committed(spark: SparkSession, out: str, sink: str) -> DataFrame:
    commits = spark.read.parquet(f"{out}/commits").select("batch").distinct()
    return spark.read.parquet(f"{out}/{sink}").join(F.broadcast(commits), "batch", "left_semi").drop("batch")  # one row a batch


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    """Scored requests of all batches that are complete."""
    return _committed(spark, out, "scored")


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return _committed(spark, out, "quarantine")
