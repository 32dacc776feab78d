"""Registered queries: the entry contract, and every cheap query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from parcelwise.sources.homes import TABLES
from tests.conftest import TESTDATA
from tests.oracle_check import compare

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TESTDATA}/{name}.parquet')")
    return con


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["end", "Neighborhood", "n", "median"]


#: Queries that SQL does not express; their own tests compare them with brute force or closed forms.
WITHOUT_SQL = {"feature_matrix", "model_comparison", "adaboost", "grid_search", "random_search", "feature_importance", "prediction_sanity"}


def test_only_named_queries_have_no_sql():
    assert set(SQL) <= set(QUERIES)
    assert {n for n in set(QUERIES) - set(SQL) if not n.startswith("op") and n != "pipeline"} == WITHOUT_SQL


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    assert compare(duck, df.columns, [tuple(r) for r in df.collect()], SQL[name]) == "ok"
