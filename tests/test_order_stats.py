"""Exact order statistics against brute force, by both ways."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import order_stats
from parcelwise.operators.order_stats import RankTarget, column_quantiles, grouped_quantiles, kth_values
from parcelwise.operators.profile import describe_all

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def skewed_rows(n=4000, seed=3):
    """One key and one value each hold a third of the rows."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.34 else f"k{rng.randint(0, 5)}", 0.0 if rng.random() < 0.34 else rng.expovariate(0.01), rng.randint(0, 10**17))
        for _ in range(n)
    ]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_column_quantiles_match_numpy(spark, limit):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, x double, h long").withColumn("y", F.col("x") * 2 + 1).repartition(5)
    got = column_quantiles(df, {"x": PS, "y": [0.5]}, direct_limit=limit)
    xs = np.array([r[1] for r in rows])
    np.testing.assert_allclose(got["x"], np.quantile(xs, PS), rtol=1e-12)
    np.testing.assert_allclose(got["y"], [np.quantile(xs * 2 + 1, 0.5)], rtol=1e-12)


@pytest.mark.parametrize("limit", [10_000, 0])
def test_grouped_quantiles_match_numpy(spark, limit):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, x double, h long").repartition(5)
    got = {r["k"]: (r["n"], r["lo"], r["mid"]) for r in grouped_quantiles(df, "k", "x", [0.25, 0.5], ["lo", "mid"], direct_limit=limit).collect()}
    for k in {r[0] for r in rows}:
        xs = [r[1] for r in rows if r[0] == k]
        assert got[k][0] == len(xs)
        np.testing.assert_allclose(got[k][1:], np.quantile(xs, [0.25, 0.5]), rtol=1e-12)


def test_narrowing_takes_several_rounds_and_stays_exact(spark):
    """Tiny sketches and residuals force many rounds, through ties at every bracket end."""
    rng = random.Random(5)
    values = [rng.choice([0, 0, 7, rng.randint(-50, 50), rng.randint(0, 10**17)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    ranks = [0, 1200, 1201, 1500, 2999]
    got = kth_values(df, F.lit("all"), F.col("v"), [RankTarget(f"r{k}", f"{k}") for k in ranks], residual_limit=60, points=24).head()
    assert [got[f"r{k}"] for k in ranks] == [sorted(values)[k] for k in ranks]


def test_rank_below_zero_is_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "v long")
    got = kth_values(df, F.lit("all"), F.col("v"), [RankTarget("none", "-1"), RankTarget("top", "n - 1")]).head()
    assert got["none"] is None and got["top"] == 2


def test_missing_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, None)], "a double, b double")
    for limit in (100, 0):
        got = column_quantiles(df, {"a": [0.5], "b": [0.5]}, direct_limit=limit)
        assert got == {"a": [2.0], "b": [None]}


def test_interpolated_not_lower_element(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "a double")
    assert column_quantiles(df, {"a": [0.5]})["a"] == [6.0]


def test_approximate_option(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("a"))
    assert abs(column_quantiles(df, {"a": [0.5]}, relative_error=0.001)["a"][0] - 5000) <= 20


def _records_read(spark, run) -> int:
    """Records that the stages of ``run`` read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._jvm.java.util.ArrayList()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_describe_reads_the_source_twice(spark, tmp_path):
    rng = random.Random(2)
    rows = [(float(rng.randrange(50)), rng.random(), rng.randrange(10**9)) for _ in range(5000)]
    spark.createDataFrame(rows, "a double, b double, c long").repartition(4).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    got = {}
    read = _records_read(spark, lambda: got.update({r["column"]: r for r in describe_all(df, direct_limit=100).collect()}))
    assert read == 2 * len(rows)
    for i, n in enumerate("abc"):
        np.testing.assert_allclose([got[n][p] for p in ("p25", "p50", "p75")], np.quantile([float(r[i]) for r in rows], [0.25, 0.5, 0.75]), rtol=1e-12)


def test_heavy_groups_are_searched_apart(spark):
    """One group holds a third of the rows, 20,000 others the rest; only the heavy one goes through the search, and its key is sent."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.pmod(F.xxhash64("id"), F.lit(20_000)))).alias("k"), (F.col("id") * 7919 % 60_000).cast("double").alias("x"))
    out = grouped_quantiles(df, "k", "x", [0.5], ["mid"], direct_limit=1000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and "strategy=broadcast" in plan and "percentile(" in plan
    got = {r["k"]: (r["n"], r["mid"]) for r in out.collect()}
    frame = df.toPandas().groupby("k")["x"]
    want = frame.agg(["size", "median"])
    assert len(got) == len(want) and all(got[k] == (n, m) for k, n, m in want.itertuples())
    assert got["hot"][0] == 20_000


def test_copies_of_a_bracket_table_too_large_to_send(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "BROADCAST_STATE_BYTES", 0)
    rows = skewed_rows(2000)
    df = spark.createDataFrame(rows, "k string, x double, h long").repartition(5)
    got = {r["k"]: r["mid"] for r in grouped_quantiles(df, "k", "x", [0.5], ["mid"], direct_limit=0).collect()}
    assert got == {k: float(np.quantile([r[1] for r in rows if r[0] == k], 0.5)) for k in {r[0] for r in rows}}


def test_a_value_held_by_all_and_a_null_group(spark):
    df = spark.createDataFrame([("a", 5.0)] * 300 + [(None, 1.0)] * 5 + [("b", None)], "k string, x double")
    got = {r["k"]: (r["n"], r["mid"]) for r in grouped_quantiles(df, "k", "x", [0.5], ["mid"], direct_limit=10).collect()}
    assert got == {"a": (300, 5.0), "b": (0, None)}
