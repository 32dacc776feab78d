"""Session helpers: local builder, reliable checkpoint folder, scratch folders."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 250_000  # rows of one task where they become feature vectors; about a kilobyte each in a tree fit


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings for wide projections.

    HotSpot does not compile methods above 8,000 bytes of bytecode, so a fused
    stage beyond that runs interpreted; with the limit set Spark falls back to
    split expressions for such stages. A value the user set is left alone.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, "8000")
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer partitions than there are cores; larger inputs stay as they are.

    For inputs of few files with much work per row. Meant for plain scans, whose
    partition count is known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().executedPlan().execute().getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and
    executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="parcelwise-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written intermediate."""
    return f"{shared_dir(spark).rstrip('/')}/parcelwise/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of a table that is read many times, computed once: written as Parquet under the shared folder and read back by column."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Partitions of at most about ``rows`` (``TASK_ROWS``) rows, so that a task's share does not grow with the table.

    For wide rows that are kept or trained on: files are cut by compressed bytes and joins merge small partitions, whatever the rows grow to
    later. Counts the table, which costs nothing for one just read from Parquet.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, math.ceil(df.count() / (rows or TASK_ROWS))))


def use_checkpoints(spark: SparkSession) -> None:
    """Name the shared folder as the place of checkpoints, for ``reliable`` and for the periodic ones of long fits."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint that outlives lost executors."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
