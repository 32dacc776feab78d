"""Inputs that files and tables really hold: ragged CSV, wide numbers, NaN, constants, empty tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import clean, contracts, correlation, encode, histogram, metrics, profile, split
from parcelwise.sources import tabular


def write(path, **files):
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_wide_whole_numbers_keep_their_digits(spark, tmp_path):
    df = tabular.read_csv(spark, write(tmp_path, a="id,long,mixed\n1234567890123456789,12345678901234567890123,1\n1234567890123456788,5,x\n"))
    assert dict(df.dtypes) == {"id": "bigint", "long": "decimal(38,0)", "mixed": "string"}
    assert sorted(r["id"] for r in df.collect()) == [1234567890123456788, 1234567890123456789]


@pytest.mark.parametrize("text", ["a,b\n1,2,3\n", "a,b\n1\n"])
def test_ragged_rows_fail(spark, tmp_path, text):
    with pytest.raises(Exception, match="(?i)malformed"):
        tabular.read_text(spark, write(tmp_path, x=text)).collect()


def test_files_with_other_headers_fail(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        tabular.read_text(spark, write(tmp_path, a="a,b\n1,2\n1,2\n1,2\n", b="b,a\n20,10\n")).collect()


def test_a_schema_does_not_hide_bad_cells(spark, tmp_path):
    path = write(tmp_path, a="year,note\n1999,x\noops,y\n")
    schema = spark.createDataFrame([], "year int, note string").schema
    rules = contracts.Contract("years", (contracts.ColumnRule("year", "int"),))
    for given in (None, schema):
        with pytest.raises(contracts.ContractError, match="is int"):
            tabular.load_raw(spark, path, rules, schema=given)
    with pytest.raises(Exception, match="column year is not int"):
        tabular.read_csv(spark, path, schema).collect()


def test_lost_ratings_are_reported(spark, tmp_path):
    path = write(tmp_path, a="Overall_Qual,Sale_Price\nGood,1\nSplendid,2\n")
    with pytest.warns(UserWarning, match="'Overall Qual': 1"):
        df = tabular.load_raw(spark, path)
    assert dict(df.dtypes)["SalePrice"] == "bigint" and {r["Overall Qual"] for r in df.collect()} == {7, None}


def test_a_split_that_was_not_written_is_an_error(spark, tmp_path):
    tabular.write_splits(spark.createDataFrame([(1, "train")], "id int, split string"), str(tmp_path / "s"))
    assert tabular.read_split(spark, str(tmp_path / "s"), "train").count() == 1
    with pytest.raises(FileNotFoundError, match="'val'"):
        tabular.read_split(spark, str(tmp_path / "s"), "val")


def test_numbers_that_a_whole_type_cannot_hold(spark):
    df = spark.createDataFrame([(1, 1e30, 1 << 40), (2, 7.5, 3), (3, 2000.0, 4), (4, float("nan"), 5)], "id int, year double, n long")
    rules = contracts.Contract("c", (contracts.ColumnRule("year", "int", False, (contracts.between(1800, 2025),)), contracts.ColumnRule("n", "int")))
    found = sorted((r["id"], r["column"], r["check"]) for r in contracts.violations(df, rules, ["id"]).collect())
    assert found == [(1, "n", "is int"), (1, "year", "is int"), (2, "year", "is int"), (4, "year", "not null")]
    valid, bad = contracts.split_valid(df, rules)
    assert [r["year"] for r in valid.collect()] == [2000] and bad.count() == 3


def test_nan_counts_as_null(spark):
    rows = [(float(i % 17), float((i * 7) % 23), "ab"[i % 2]) for i in range(200)]
    gaps = [(None if i % 9 == 0 else x, None if i % 11 == 0 else y, g) for i, (x, y, g) in enumerate(rows)]
    nans = [tuple(math.nan if v is None else v for v in r) for r in gaps]
    a, b = (spark.createDataFrame(r, "x double, y double, g string") for r in (gaps, nans))
    for run in (
        lambda d: histogram.histogram(d, "x"), lambda d: histogram.histogram(d, "x", 0.0, 2.0, by="g"), lambda d: histogram.density_curve(d, "x", 20),
        lambda d: histogram.scatter_grid(d, "x", "y", 3.0, 3.0), lambda d: histogram.regression_line(d, "x", "y"), lambda d: histogram.banded_histogram(d, "x", [0.0, 5.0]),
        lambda d: profile.target_summary(d, "x"), lambda d: profile.schema_report(d), lambda d: profile.describe_all(d), lambda d: correlation.correlation_pairs(d, ["x", "y"]),
        lambda d: correlation.top_correlations(d, "y", 1, ["x"]), lambda d: metrics.regression_metrics(d, "x", "y", ["g"]), lambda d: profile.skew_profile(d),
    ):
        def plain(df):
            return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())
        assert plain(run(a)) == plain(run(b))
    assert clean.narrow_types(b).dtypes[:2] == [("x", "float"), ("y", "float")]


@pytest.mark.parametrize("value", [0.1, 0.3])
@pytest.mark.parametrize("gaps", [0, 3])
def test_constants_scale_to_zero(spark, value, gaps):
    df = spark.createDataFrame([(value if i >= gaps else None,) for i in range(1000)], "x double").repartition(7)
    fill, scale = clean.fit_fill_and_scale(df, ["x"])
    filled = df.fillna(fill)
    assert filled.count() == 1000 and {r[0] for r in encode.apply_scale(filled, scale).collect()} == {0.0}
    assert {r[0] for r in encode.apply_scale(filled, encode.fit_scale(filled, ["x"])).collect()} == {0.0}


def test_fingerprint_tells_shifted_cells_apart(spark):
    one, other = (spark.createDataFrame([r], "a string, b string") for r in (("a|=b", "c"), ("a", "b|=c")))
    assert profile.fingerprint(one).first()["fingerprint"] != profile.fingerprint(other).first()["fingerprint"]


def test_bins_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert df.select(split.quantile_bin(F.col("x"), split.quantile_edges(df, "x"))).count() == 0


def test_density_is_as_close_to_the_exact_curve_as_stated(spark):
    rng = np.random.default_rng(3)
    for values in (rng.random(3000) * 10 + np.arange(3000) % 7, rng.exponential(5, 500), np.repeat([0.0, 1.0], 40)):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        for fine in (64, 4096):
            got = histogram.density_curve(df, "x", 30, fine).orderBy("point").toPandas()
            h = values.std(ddof=1) * len(values) ** -0.2
            x = np.linspace(values.min(), values.max(), 30)
            exact = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
            step = (values.max() - values.min()) / 29 / -(-fine // 29)
            assert np.abs(got["density"] - exact).max() <= step**2 / (8 * h**3 * np.sqrt(2 * np.pi)) + 1e-12


def test_exact_density_sums_the_kernel_of_every_value(spark):
    values = np.concatenate([np.random.default_rng(5).exponential(5, 700), np.repeat([2.0, 40.0], 30)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double")
    got = histogram.density_curve(df, "x", 30, fine=None).orderBy("point").toPandas()
    h, x = values.std(ddof=1) * len(values) ** -0.2, np.linspace(values.min(), values.max(), 30)
    exact = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.abs(got["density"] - exact).max() <= 1e-14


def test_density_writes_no_row_for_each_value(spark):
    plan = histogram.density_curve(spark.range(1000).select(F.col("id").cast("double").alias("x")), "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Scan") if "Scan" in plan else True
    leaf = plan[plan.rindex("Range"):] if "Range" in plan else plan
    assert "Generate" not in leaf and plan.count("HashAggregate") >= 4  # the first generator stands above a partial and a final count


def test_small_sides_are_sent_to_the_tasks(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("g"))
    for run in (lambda: profile.label_shares(df), lambda: encode.collapse_rare_labels(df, 0.01, "g")):
        assert "BroadcastHashJoin" in run()._jdf.queryExecution().executedPlan().toString()
