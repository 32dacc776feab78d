"""Any number of labels, encoded: a distributed dictionary with gapless numbers, and sparse vectors built by join.

The dictionary is a table. Labels are numbered in the order of (column, label) without ordering them in one task: they are dealt to
sorted ranges, each range is counted, and a range's offset is the count of all before it (one number a range reaches the driver).
Rows find their labels' numbers by joins; as numbers follow the columns, a row's numbers are already sorted slots and
nothing is gathered by key. No label list is ever held by the driver or written into a plan.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.names import c
from ..session import reliable
from .profile import category_counts

#: Labels of a column that are sent to every task; more are joined by a shuffle.
BROADCAST_LABELS = 500_000


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Add gapless numbers from 0 in the given order, which must tell all rows apart. Runs two small jobs."""
    ranged = reliable(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = {r["__range"]: r["n"] for r in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = sorted(counts)
    offsets = list(accumulate([0] + [counts[i] for i in ranges]))
    side = df.sparkSession.createDataFrame(list(zip(ranges, offsets)), "__range int, __offset long")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.join(F.broadcast(side), "__range").withColumn(name, F.col("__offset") + inside - 1).drop("__range", "__offset")


def fit_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, n, number``: every label of the columns, numbered without gaps over all columns."""
    return reliable(numbered(category_counts(df, columns), ["column", "value"]))


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    """Labels per column."""
    return {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def _joined(df: DataFrame, column: str, side: DataFrame, size: int) -> DataFrame:
    """Left join on a label. While the side can be sent a hot label moves no rows; beyond that Spark splits skewed partitions."""
    return df.join(F.broadcast(side) if size <= BROADCAST_LABELS else side, c(column) == F.col("__value"), "left").drop("__value")


def label_numbers(df: DataFrame, columns: list[str], dictionary: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """Replace each column by its labels' numbers; NULL for missing and unknown labels."""
    sizes = sizes or dictionary_sizes(dictionary)
    names = df.columns
    for n in columns:
        mine = dictionary.where(F.col("column") == n).select(F.col("value").alias("__value"), F.col("number").alias("__number"))
        df = _joined(df, n, mine, sizes.get(n, 0)).withColumn(n, F.col("__number")).drop("__number")
    return df.select(*[c(n) for n in names])


def sparse_vector(size: int, slots: Column) -> Column:
    """An ML vector from sorted ``(slot, value)`` structs, by way of the vector's own struct form; stays in the JVM."""
    form = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), F.transform(slots, lambda s: s["slot"].cast("int")).alias("indices"),
        F.transform(slots, lambda s: s["value"]).alias("values"))
    return F.from_json(F.to_json(F.struct(form.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def add_features(
    df: DataFrame, columns: list[str], dictionary: DataFrame, numbers: list[str], output: str = "features", sizes: dict[str, int] | None = None,
) -> DataFrame:
    """Append one sparse vector: a slot for each of the numbers, then one for each label in the dictionary's order.

    ``columns`` in the dictionary's order, that is sorted by name. The other columns stay as they are.
    """
    sizes = sizes or dictionary_sizes(dictionary)
    first, names = len(numbers), df.columns
    columns = sorted(columns)
    coded = df.withColumns({f"__label_{i}": c(n) for i, n in enumerate(columns)})
    for i, n in enumerate(columns):
        mine = dictionary.where(F.col("column") == n).select(F.col("value").alias("__value"), F.col("number").alias(f"__number_{i}"))
        coded = _joined(coded, f"__label_{i}", mine, sizes.get(n, 0))

    def slot(at: Column, value: Column) -> Column:
        return F.struct(at.cast("long").alias("slot"), value.cast("double").alias("value"))

    given = [F.when(c(n) != 0, slot(F.lit(i), c(n))) for i, n in enumerate(numbers)]
    hot = [F.when(F.col(f"__number_{i}").isNotNull(), slot(F.col(f"__number_{i}") + first, F.lit(1.0))) for i in range(len(columns))]
    vector = sparse_vector(first + sum(sizes.values()), F.array_compact(F.array(*given, *hot)))
    return coded.select(*[c(n) for n in names], vector.alias(output))


def frequent_table(df: DataFrame, threshold: float, columns: list[str]) -> DataFrame:
    """``column, value`` of the labels that hold at least a share of their column's present values, however many."""
    counts = category_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))  # one row a column
    return reliable(counts.join(F.broadcast(totals), "column").where(F.col("n") / F.col("total") >= threshold).select("column", "value"))


def keep_frequent(df: DataFrame, columns: list[str], kept: DataFrame, other: str) -> DataFrame:
    """Labels that the table does not have become ``other``, missing ones too."""
    sizes, names = dictionary_sizes(kept), df.columns
    for n in columns:
        mine = kept.where(F.col("column") == n).select(F.col("value").alias("__value"), F.col("value").alias("__kept"))
        df = _joined(df, n, mine, sizes.get(n, 0)).withColumn(n, F.coalesce("__kept", F.lit(other))).drop("__kept")
    return df.select(*[c(n) for n in names])
