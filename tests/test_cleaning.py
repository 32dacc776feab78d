"""Contracts, cleaning, derived features and encoders."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import clean, contracts, encode, housing


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_valid_sales_pass_and_extra_columns_are_allowed(sales):
    assert contracts.enforce(sales.withColumn("extra", F.lit(1)), housing.RAW_CONTRACT).count() == sales.count()


@pytest.mark.parametrize("column, value", [("SalePrice", -1.0), ("SalePrice", 2_000_000.0), ("Overall Qual", 99), ("Yr Sold", 2099), ("Mo Sold", 13), ("Year Built", 1700)])
def test_bad_value_is_reported_and_raises(sales, column, value):
    bad = sales.withColumn(column, F.when(F.col("PID") == 3, value).otherwise(F.col(f"`{column}`")))
    found = contracts.violations(bad, housing.RAW_CONTRACT, ["PID"]).collect()
    assert [(r["PID"], r["column"]) for r in found] == [(3, column)]
    with pytest.raises(contracts.ContractError, match=column):
        contracts.enforce(bad, housing.RAW_CONTRACT)


def test_all_violations_are_collected(sales):
    bad = sales.withColumn("SalePrice", F.when(F.col("PID") == 1, -5.0).when(F.col("PID") == 2, None).otherwise(F.col("SalePrice")))
    bad = bad.withColumn("Yr Sold", F.when(F.col("PID") == 1, "soon").otherwise(F.col("`Yr Sold`").cast("string")))
    found = {(r["PID"], r["column"], r["check"], r["value"]) for r in contracts.violations(bad, housing.RAW_CONTRACT, ["PID"]).collect()}
    assert found == {(1, "SalePrice", "> 0", "-5.0"), (2, "SalePrice", "not null", None), (1, "Yr Sold", "is long", "soon")}
    valid, bad_rows = contracts.split_valid(bad, housing.RAW_CONTRACT)
    assert valid.count() == sales.count() - 2 and bad_rows.count() == 2
    assert dict(valid.dtypes)["Yr Sold"] == "bigint"


def test_gaps_in_nullable_columns_survive(sales):
    gappy = sales.withColumn("Garage Cars", F.when(F.col("PID") < 6, None).otherwise(F.col("`Garage Cars`")))
    assert contracts.enforce(gappy, housing.RAW_CONTRACT).where(F.col("`Garage Cars`").isNull()).count() == 6


def test_missing_column_is_reported_once(sales):
    found = contracts.violations(sales.drop("Mo Sold"), housing.RAW_CONTRACT, ["PID"]).collect()
    assert [(r["PID"], r["column"], r["check"]) for r in found] == [(None, "Mo Sold", "column exists")]
    with pytest.raises(contracts.ContractError, match="Mo Sold"):
        contracts.enforce(sales.drop("Mo Sold"), housing.RAW_CONTRACT)


def test_sparse_threshold_is_strict(spark):
    df = spark.createDataFrame([(i, None if i < 30 else 1, None if i < 31 else 1, None) for i in range(100)], "a int, b int, d int, e string")
    assert clean.sparse_columns(df, 0.30) == ["d", "e"]
    assert clean.sparse_columns(df, 0.30, columns=["b", "absent"]) == []


def test_fills(spark):
    df = spark.createDataFrame([(1.0, 2, "b"), (2.0, None, "a"), (10.0, 4, "b"), (20.0, 5, "a"), (None, 4, None)], "x double, n int, s string")
    median = clean.fit_fill(df)
    assert median.values == {"x": 6.0, "n": 4.0, "s": "a"}
    filled = clean.apply_fill(df, median)
    assert filled.where("x IS NULL OR n IS NULL OR s IS NULL").count() == 0 and filled.where("x = 6").count() == 1
    assert clean.fit_fill(df, "mean").values["x"] == pytest.approx(8.25)
    assert clean.fit_fill(df, "most_frequent").values["n"] == 4.0
    assert clean.fit_fill(df, "constant", "constant").values == {"x": 0.0, "n": 0.0, "s": "missing"}
    with pytest.raises(ValueError):
        clean.fit_fill(df, "guess")


def test_fill_and_scale_in_one_pass_equals_two(spark, sales):
    gappy = sales.withColumn("Lot Frontage", F.when(F.col("PID") % 5 == 0, None).otherwise(F.col("`Lot Frontage`")))
    names = ["Lot Frontage", "Overall Qual", "Bsmt Half Bath"]
    fill, scale = clean.fit_fill_and_scale(gappy, names)
    filled = clean.apply_fill(gappy, clean.Fill(fill))
    two = encode.fit_scale(filled, names)
    for n in names:
        assert scale.mean[n] == pytest.approx(two.mean[n]) and scale.deviation[n] == pytest.approx(two.deviation[n])


def test_iqr_bounds_are_inclusive_and_drop_missing(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 8.0, 9.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bounds = clean.fit_iqr_bounds(df, "x")
    q1, q3 = np.quantile([v for v in values[:7]], [0.25, 0.75])
    assert (bounds.low, bounds.high) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    on_edge = spark.createDataFrame([(bounds.high,), (bounds.low,), (bounds.high + 1e-9,), (None,), (float("nan"),)], "x double")
    assert clean.apply_bounds(on_edge, bounds).count() == 2


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 2**40, 1.5, 1e300, None)], "a long, b long, x double, y double, z double")
    assert dict(clean.narrow_types(df).dtypes) == {"a": "int", "b": "bigint", "x": "float", "y": "double", "z": "double"}


def test_derived_features(sales):
    for r in housing.add_features(sales).collect():
        assert r["TotalSF"] == r["Total Bsmt SF"] + r["1st Flr SF"] + r["2nd Flr SF"]
        assert r["TotalBath"] == r["Full Bath"] + 0.5 * r["Half Bath"] + r["Bsmt Full Bath"] + 0.5 * r["Bsmt Half Bath"]
        assert r["HouseAge"] == max(r["Yr Sold"] - r["Year Built"], 0) and r["RemodelAge"] == max(r["Yr Sold"] - r["Year Remod/Add"], 0)
        assert r["IsRemodeled"] == int(r["Year Built"] != r["Year Remod/Add"]) and r["HasPool"] == int(r["Pool Area"] > 0)
        assert r["LotToLivRatio"] == pytest.approx(r["Lot Area"] / r["Gr Liv Area"])


def test_derived_feature_null_rules(spark):
    schema = "`Year Built` int, `Year Remod/Add` int, `Yr Sold` int, `Total Bsmt SF` double, `Lot Area` double, `Gr Liv Area` double, `Garage Area` double"
    df = spark.createDataFrame([(2000, None, 2008, None, 100.0, 0.0, None), (None, 2000, 2008, 5.0, None, 10.0, 1.0)], schema)
    a, b = housing.add_features(df).collect()
    assert (a["IsRemodeled"], b["IsRemodeled"]) == (1, 1)
    assert a["RemodelAge"] is None and b["HouseAge"] is None and a["TotalSF"] is None and b["TotalSF"] == 5.0
    assert (a["HasBasement"], b["HasBasement"], a["HasGarage"], b["HasGarage"]) == (0, 1, 0, 1)
    assert (a["LotToLivRatio"], b["LotToLivRatio"]) == (0.0, 0.0)
    assert (a["HasPool"], a["QualCond"], a["PorchSF"]) == (0, 0, 0)  # absent sources count as 0


def test_skew_log(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(rng.exponential(size=500))], "e double, u double")
    assert encode.skewed_columns(df) == ["e"] and encode.skewed_columns(df, exclude=["e"]) == []
    tricky = spark.createDataFrame([(-100.0,), (-1.0,), (0.0,), (1.0,), (None,)], "e double")
    got = [r[0] for r in encode.log_columns(tricky, ["e", "absent"]).collect()]
    assert got == [0.0, 0.0, 0.0, pytest.approx(math.log(2)), None]


def test_rare_labels(spark):
    rows = [("A",)] * 90 + [("B",)] * 8 + [("O'x",)] * 2 + [(None,)] * 5
    df = spark.createDataFrame(rows, "city string")
    fitted = encode.fit_frequent_labels(df, 0.05)
    assert fitted.labels == {"city": ["A", "B"]}
    new = spark.createDataFrame([("A",), ("B",), ("O'x",), ("UNSEEN",), (None,)], "city string")
    assert [r[0] for r in encode.apply_frequent_labels(new, fitted).collect()] == ["A", "B", "Other", "Other", "Other"]
    assert encode.fit_frequent_labels(df, 0.02).labels["city"] == ["A", "B", "O'x"]  # threshold is inclusive
    joined = encode.collapse_rare_labels(df, 0.05, "city")
    assert rows_of(joined) == rows_of(encode.apply_frequent_labels(df, fitted))


def test_one_hot_and_back(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a'"), (3, None)], "id int, g string")
    fitted = encode.fit_indicators(df)
    wide = encode.apply_indicators(df, fitted)
    assert wide.columns == ["id", "g_a'", "g_b"] and rows_of(wide) == [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0)]
    assert rows_of(encode.melt_indicators(wide, "g_", ["id"], "g")) == [(1, "g_b"), (2, "g_a'")]
    with pytest.raises(ValueError):
        encode.fit_indicators(df, limit=1)


def test_scale_is_population_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, k double")
    got = encode.apply_scale(df, encode.fit_scale(df)).toPandas()
    assert got["x"].mean() == pytest.approx(0) and got["x"].std(ddof=0) == pytest.approx(1) and list(got["k"]) == [0, 0, 0]
