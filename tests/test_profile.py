"""Profiles against pandas on the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import correlation, histogram, profile


@pytest.fixture(scope="module")
def gappy(spark, sales):
    return sales.withColumn("Lot Frontage", F.when(F.col("PID") % 5 == 0, None).otherwise(F.col("`Lot Frontage`"))).withColumn(
        "Garage Area", F.when(F.col("PID") % 7 == 0, None).otherwise(F.col("`Garage Area`")))


@pytest.fixture(scope="module")
def frame(gappy):
    return gappy.toPandas()


def test_missing_profile(gappy, frame):
    got = profile.missing_profile(gappy).collect()
    want = frame.isnull().sum()
    want = want[want > 0].sort_values(ascending=False)
    assert [(r["column"], r["n_missing"]) for r in got] == list(want.items())
    assert all(r["percent"] == round(100 * r["n_missing"] / len(frame), 2) for r in got)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "a double")
    assert profile.missing_counts(df) == (3, {"a": 2})


def test_skewness_is_bias_corrected(gappy, frame):
    got = {r["column"]: r["skewness"] for r in profile.skew_profile(gappy).collect()}
    want = frame.select_dtypes("number").skew()
    for name in got:
        assert got[name] == pytest.approx(want[name], rel=1e-9, abs=1e-9)


def test_skewness_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "few double, constant double")
    got = {r["column"]: r["skewness"] for r in profile.skew_profile(df).collect()}
    assert got == {"few": None, "constant": 0.0}


def test_describe_all(gappy, frame):
    got = {r["column"]: r for r in profile.describe_all(gappy).collect()}
    want = frame.describe(include="all").T
    assert set(got) == set(want.index)
    for name, row in want.iterrows():
        assert got[name]["count"] == row["count"]
        if pd.isna(row["mean"]):
            assert (got[name]["unique"], got[name]["freq"]) == (row["unique"], row["freq"])
        else:
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert got[name][ours] == pytest.approx(row[theirs], rel=1e-9, abs=1e-9)


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert profile.modes(df, ["x"]) == {"x": "a"}


def test_correlations_pairwise_complete(gappy, frame):
    names = list(frame.select_dtypes("number").columns)
    want = frame[names].corr()
    for r in correlation.correlation_matrix(gappy, names).collect():
        if r["corr"] is None:
            assert np.isnan(want.loc[r["x"], r["y"]])
        else:
            assert r["corr"] == pytest.approx(want.loc[r["x"], r["y"]], abs=1e-9)
    ranked = want["SalePrice"].drop("SalePrice").sort_values(ascending=False).index[:10]
    assert [r["column"] for r in correlation.top_correlations(gappy, "SalePrice").collect()] == list(ranked)


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 2.0)], "a double, b double, d double")
    got = {(r["x"], r["y"]): r["corr"] for r in correlation.correlation_pairs(df).collect()}
    assert got[("a", "b")] is None and got[("a", "d")] == pytest.approx(1.0)
    matrix = {(r["x"], r["y"]): r["corr"] for r in correlation.correlation_matrix(df).collect()}
    assert matrix[("a", "b")] is None and matrix[("b", "b")] is None and matrix[("d", "a")] == pytest.approx(1.0)


def test_fingerprint_ignores_order_and_partitions(spark, sales):
    one = profile.fingerprint(sales.repartition(1)).head()
    assert one == profile.fingerprint(sales.repartition(7).orderBy(F.desc("PID"))).head()
    assert one != profile.fingerprint(sales.withColumn("Alley", F.coalesce("Alley", F.lit("")))).head()


def test_auto_histogram_matches_numpy(sales, frame):
    counts, edges = np.histogram(frame["SalePrice"], bins="auto")
    got = {r["bin"]: r for r in histogram.histogram(sales, "SalePrice").collect()}
    assert [got[i]["n"] if i in got else 0 for i in range(len(counts))] == list(counts)
    assert got[max(got)]["upper"] == pytest.approx(edges[-1])


def test_density_curve_integrates_to_about_one(sales):
    for fine in (100, 4096):
        rows = histogram.density_curve(sales, "SalePrice", 100, fine).orderBy("point").collect()
        area = np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows])
        assert 0.9 < area < 1.01


def test_bands_and_groups(sales, frame):
    bands = histogram.banded_histogram(sales, "SalePrice", [0.0, 100000.0, 200000.0]).collect()
    assert sum(r["n"] for r in bands) == len(frame) and sum(r["share"] for r in bands) == pytest.approx(1.0)
    got = histogram.extreme_groups(sales, "Neighborhood", "SalePrice", 2).collect()
    want = frame.groupby("Neighborhood")["SalePrice"].median().sort_values(ascending=False)
    assert [r["Neighborhood"] for r in got if r["end"] == "highest"] == list(want.index[:2])
    assert [r["median"] for r in got if r["end"] == "lowest"] == pytest.approx(sorted(want)[:2])


def test_label_shares_leave_gaps_out(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert {r["value"]: r["share"] for r in profile.label_shares(df).collect()} == {"a": 2 / 3, "b": 1 / 3}
