"""Exact splits where rows share keys, and draws from a search space."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import split, tuning
from parcelwise.operators.models import boosted_trees


def shares(df):
    return Counter(r["split"] for r in df.collect())


def test_a_hundred_rows_with_three_keys(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("x")).repartition(5)
    got = split.stratified_split(df, "k", F.lit("all"))
    assert shares(got) == {"test": 15, "val": 15, "train": 70}
    assert sorted(r["x"] for r in got.collect()) == list(range(100))
    again = split.stratified_split(df.repartition(2), "k", F.lit("all"))
    assert {r["x"]: r["split"] for r in got.collect()} == {r["x"]: r["split"] for r in again.collect()}


@pytest.mark.parametrize("copies", [3, 10_000])
def test_equal_rows_are_counted_off(spark, monkeypatch, copies):
    monkeypatch.setattr(split, "COPIES", copies)
    df = spark.range(200).select(F.lit(7).alias("k"), F.when(F.col("id") < 150, "same").otherwise(F.concat(F.lit("o"), F.col("id"))).alias("x"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"))
    got = split.stratified_split(df, "k", F.col("s"))
    for s in "ab":
        assert shares(got.where(F.col("s") == s)) == {"test": 15, "val": 15, "train": 70}
    assert Counter(r["x"] for r in got.collect()) == Counter(r["x"] for r in df.collect())


def test_null_keys_and_unique_keys(spark):
    df = spark.range(60).select(F.when(F.col("id") >= 40, F.col("id")).alias("k"), F.col("id").alias("x"))
    assert shares(split.stratified_split(df, "k", F.lit("all"))) == {"test": 9, "val": 9, "train": 42}
    unique = split.stratified_split(df, "x", F.lit("all"))
    assert shares(unique) == {"test": 9, "val": 9, "train": 42} and "Union" not in unique._jdf.queryExecution().optimizedPlan().toString()


def test_draws_from_a_space_that_is_never_listed():
    space = {f"p{i}": range(1000) for i in range(3)}
    drawn = tuning.draw_points(space, 50, 1)
    assert len({tuple(x.values()) for x in drawn}) == 50 and drawn == tuning.draw_points(space, 50, 1) != tuning.draw_points(space, 50, 2)
    assert {len({x[n] for x in drawn}) > 40 for n in space} == {True}
    small = tuning.draw_points({"a": [1, 2, 3], "b": ["x", "y"]}, 50)
    assert sorted((x["a"], x["b"]) for x in small) == [(a, b) for a in (1, 2, 3) for b in "xy"]
    assert tuning.draw_points({"a": []}, 5) == []


def test_ranges_are_drawn_evenly():
    space = {"rate": tuning.Between(0.01, 1.0, log=True), "depth": tuning.Between(2, 6, whole=True), "kind": ["x", "y"]}
    drawn = tuning.draw_points(space, 400, 3)
    assert len(drawn) == 400 and Counter(x["depth"] for x in drawn).keys() == {2, 3, 4, 5, 6}
    assert all(0.01 <= x["rate"] < 1 for x in drawn) and 0.35 < sum(x["rate"] < 0.1 for x in drawn) / 400 < 0.65
    named = tuning.sample_params(boosted_trees(), {"stepSize": tuning.Between(0.01, 0.3), "maxDepth": [3, 4]}, 5)
    assert [sorted(p.name for p in m) for m in named] == [["maxDepth", "stepSize"]] * 5
