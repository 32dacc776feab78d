"""What fits on large tables read: bounded shares of a task, tables computed once."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from parcelwise import session
from parcelwise.operators import clean, contracts, ensembles, models
from parcelwise.plans import catalog, preprocess
from tests.conftest import TESTDATA


def shares(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


class Stop(Exception):
    pass


def test_shares_do_not_grow_with_the_table(spark):
    for n in (1000, 5000):
        assert max(shares(session.dealt(spark.range(n).coalesce(1), 100))) <= 130


@pytest.mark.parametrize("make", ["_matrix", "_labelled_once"])
def test_rows_of_a_fit_are_dealt(spark, monkeypatch, make):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    found = shares(getattr(catalog, make)(spark, TESTDATA))
    assert sum(found) == 1500 and max(found) <= 130


def test_sanity_trees_are_fitted_on_dealt_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    seen = []

    class Watching:
        def fit(self, df):
            seen.extend(shares(df))
            raise Stop

    monkeypatch.setattr(models, "boosted_trees", Watching)
    with pytest.raises(Stop):
        catalog.prediction_sanity(spark, TESTDATA)
    assert sum(seen) == 1500 and max(seen) <= 130


def test_boosting_keeps_the_rows_of_a_round(spark, sales, monkeypatch):
    seen = []

    class Watching(DecisionTreeRegressor):
        def fit(self, df):
            seen.append(df.storageLevel.useMemory)
            return super().fit(df)

    data = VectorAssembler(inputCols=["Overall Qual", "Gr Liv Area"], outputCol="features").transform(sales.withColumnRenamed("SalePrice", "label"))
    data.count()  # fills the cache of the fixture
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(ensembles, "DecisionTreeRegressor", Watching)
    assert models.AdaBoostR2(rounds=4, cut_every=3).fit(data).n_trees == 4
    assert seen == [False, True, True, False]  # first and fourth come from a checkpoint
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_preparation_parses_the_file_once(spark, sales, tmp_path):
    sales.write.option("header", True).csv(f"{tmp_path}/in")
    rules = contracts.Contract("prices", (contracts.ColumnRule("SalePrice", "double", False),))
    done = preprocess.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", contract=rules, processed=rules)
    assert done.table.inputFiles() and not [f for f in done.table.inputFiles() if f.endswith(".csv")]


def test_preparation_reads_joined_rows_once(spark):
    assert not [f for f in catalog.prepared_table(spark, TESTDATA).inputFiles() if "orders.parquet" in f]


def test_moments_and_sketches_come_in_one_pass(spark, sales, monkeypatch):
    names = ["SalePrice", "Lot Frontage", "Overall Qual"]
    want = clean.fit_fill_and_scale(sales, names)
    used = []

    def watching(*args, **options):
        used.append(sorted(options["sketches"]))
        return quantiles(*args, **options, direct_limit=10)

    quantiles = clean.column_quantiles
    monkeypatch.setattr(clean, "DIRECT_LIMIT", 10)
    monkeypatch.setattr(clean, "column_quantiles", watching)
    got = clean.fit_fill_and_scale(sales, names)
    assert used == [sorted(names)] and got[0] == pytest.approx(want[0])
    assert got[1].mean == pytest.approx(want[1].mean) and got[1].deviation == pytest.approx(want[1].deviation)
