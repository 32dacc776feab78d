"""CSV reading, name normalisation, requests, batch and streaming scoring."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from parcelwise.operators import models
from parcelwise.plans import scoring, stages
from parcelwise.sources import requests, tabular
from parcelwise.streaming.score_stream import read_request_stream, start_scoring

GOOD = {"OverallQual": 7, "GrLivArea": 1710.0, "YearBuilt": 2003, "Neighborhood": "CollgCr", "GarageCars": 2.0,
        "GarageArea": 548.0, "TotalBsmtSF": 856.0, "FullBath": 2, "YrSold": 2008}


def write_json(path, records):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("\n".join(map(json.dumps, records)))
    return str(path)


@pytest.fixture(scope="module")
def model(sales):
    df = sales.withColumn("label", F.log1p("SalePrice")).drop("PID", "Order", "SalePrice")
    return Pipeline(stages=[stages.build_features(False, ["label"]), models.boosted_trees(trees=5)]).fit(df)


def test_csv_types_and_null_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x,ok,s,none\n1,1.5,True,a b,NA\n2,NA,False,null,\n003,-2e3,True,7,NaN\n")
    df = tabular.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"id": "bigint", "x": "double", "ok": "boolean", "s": "string", "none": "string"}
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, True, "a b", None), (2, None, False, None, None), (3, -2000.0, True, "7", None)]
    typed = tabular.read_csv(spark, str(tmp_path / "a.csv"), schema=df.schema, null_tokens=["NA"])
    assert typed.where("s = 'null'").count() == 1


def test_normalise_names(spark):
    df = spark.createDataFrame([("Very_Good", "Above Average", 1, 2.0, 3)], "Overall_Qual string, Overall_Cond string, Year_Remod_Add int, Longitude double, Sale_Price int")
    out = tabular.normalise_names(df)
    assert out.columns == ["Overall Qual", "Overall Cond", "Year Remod/Add", "SalePrice"] and tuple(out.head()) == (8, 6, 1, 3)
    assert tabular.normalise_names(out).columns == out.columns
    assert tabular.unmapped_labels(spark.createDataFrame([("Odd",), ("Fair",), (None,)], "q string"), ["q"]).head()["n_unmapped"] == 1


def test_request_rules(spark, tmp_path):
    bad = [{k: v for k, v in GOOD.items() if k != "OverallQual"}, GOOD | {"OverallQual": 99}, GOOD | {"YearBuilt": 2999}, GOOD | {"GrLivArea": -100},
           GOOD | {"ExterQual": "Great"}, GOOD | {"GarageCars": 6}, GOOD | {"FullBath": "two"}]
    df = requests.read_requests(spark, write_json(tmp_path / "in", [GOOD, GOOD | {"FullBath": 2.0}] + bad))
    checked = scoring.check_requests(df).collect()
    assert [len(r["reasons"]) for r in checked] == [0, 0] + [1] * 7
    assert [r["reasons"][0]["column"] for r in checked[2:]] == ["OverallQual", "OverallQual", "YearBuilt", "GrLivArea", "ExterQual", "GarageCars", "FullBath"]


def test_defaults_and_names(spark, tmp_path):
    df = requests.read_requests(spark, write_json(tmp_path / "in", [GOOD, GOOD | {"SecondFlrSF": 300.0, "YearRemodAdd": 2005}]))
    a, b = scoring.valid_inputs(scoring.check_requests(df)).collect()
    assert (a["Year Remod/Add"], a["1st Flr SF"], a["Overall Cond"], a["MS Zoning"], a["Lot Area"], a["2nd Flr SF"]) == (2003, 1710.0, 5, "RL", 9600.0, 0.0)
    assert (b["Year Remod/Add"], b["2nd Flr SF"], b["Overall Qual"]) == (2005, 300.0, 7)


def test_scores(spark, model, tmp_path):
    df = requests.read_requests(spark, write_json(tmp_path / "in", [GOOD | {"rid": i} for i in range(120)] + [GOOD | {"rid": 999, "OverallQual": 0}]), {"rid": "long"})
    scored, rejected = scoring.score(model, df, ["rid"])
    rows = scored.collect()
    assert len(rows) == 120 and len({r["prediction_id"] for r in rows}) == 120 and [r["rid"] for r in rejected.collect()] == [999]
    for r in rows:
        assert 10_000 < r["lower_bound"] < r["predicted_price"] < r["upper_bound"] < 2_000_000
        assert r["lower_bound"] == pytest.approx(r["predicted_price"] * 0.91, abs=0.02) and r["model_version"] == "0.1.0"


def test_stream_equals_batch(spark, model, tmp_path):
    records = [GOOD | {"rid": i, "OverallQual": i % 12} for i in range(24)]
    path = write_json(tmp_path / "in", records)
    stream = read_request_stream(spark, path, {"rid": "long"})
    run = lambda: start_scoring(stream, model, str(tmp_path / "out"), str(tmp_path / "state"), ["rid"], once=True, stamp=False).awaitTermination()
    run()
    run()  # nothing new: the sinks stay as they are
    got = spark.read.parquet(str(tmp_path / "out/scored")).drop("batch")
    want, rejected = scoring.score(model, requests.read_requests(spark, path, {"rid": "long"}), ["rid"], stamp=False)
    assert got.count() == want.count() == 20 and got.exceptAll(want).count() == 0
    bad = spark.read.parquet(str(tmp_path / "out/quarantine"))
    assert sorted(r["rid"] for r in bad.collect()) == sorted(r["rid"] for r in rejected.collect()) == [0, 11, 12, 23]
