"""Encoding with any number of labels, against the route for few."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from parcelwise.operators import encode, label_numbers
from parcelwise.plans import preprocess, stages


def test_numbers_are_gapless_and_sorted(spark):
    df = spark.createDataFrame([(f"v{i % 700}", "a" if i % 3 else None) for i in range(3000)], "t string, u string").repartition(7)
    got = label_numbers.fit_dictionary(df, ["u", "t"]).orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(701))
    assert [(r["column"], r["value"]) for r in got] == sorted([("t", f"v{i}") for i in range(700)] + [("u", "a")])
    assert sum(r["n"] for r in got) == 5000


def test_three_hundred_thousand_labels(spark):
    """One label fills a third of the rows; both join routes give every row its label's slot."""
    df = spark.range(450_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("label "), F.col("id").cast("string"))).alias("t"), (F.col("id") % 5).cast("double").alias("x"))
    dictionary = label_numbers.fit_dictionary(df, ["t"])
    assert label_numbers.dictionary_sizes(dictionary) == {"t": 300_001}
    assert encode.counted_labels(df, ["t"]) is None
    out = label_numbers.add_features(df, ["t"], dictionary, ["x"])
    coded = label_numbers.label_numbers(df.withColumn("label", F.col("t")), ["t"], dictionary)
    back = coded.join(dictionary.select(F.col("number").alias("t"), "value"), "t")
    assert back.where("value <> label").count() == 0 and back.count() == 450_000
    row = out.where("id = 4").first()["features"]
    number = dictionary.where("value = 'label 4'").first()["number"]
    assert row.size == 300_002 and row.indices.tolist() == [0, 1 + number] and row.values.tolist() == [4.0, 1.0]


@pytest.mark.parametrize("sent", [0, 10**6])
def test_dictionary_gives_the_same_vectors_as_lists(spark, sales, monkeypatch, sent, tmp_path):
    monkeypatch.setattr(label_numbers, "BROADCAST_LABELS", sent)
    df = sales.select("PID", "SalePrice", "Gr Liv Area", "Lot Frontage", "Neighborhood", "MS Zoning", "Alley")
    skip = ["PID", "SalePrice"]
    few = stages.MatrixBuilder(exclude=skip).fit(df)
    many = stages.MatrixBuilder(exclude=skip, limit=3).fit(df)
    assert isinstance(many.stages[-1], stages.DictionaryAssemblerModel)
    unseen = df.limit(20).unionByName(df.limit(1).withColumn("Neighborhood", F.lit("nowhere")).withColumn("PID", F.lit(-1).cast("long")))
    names = stages.feature_names(few.transform(df))
    order = {n: i for i, n in enumerate(names)}
    numbers = many.stages[-1].fitted["numbers"]
    slots = numbers + [f"{r['column']}_{r['value']}" for r in many.stages[-1].table.orderBy("number").collect()]
    many.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    want = {r["PID"]: r["features"].toArray() for r in few.transform(unseen).collect()}
    for model in (many, again):
        got = {r["PID"]: r["features"].toArray() for r in model.transform(unseen).collect()}
        assert set(got) == set(want)
        for k, v in got.items():
            assert v.tolist() == pytest.approx([want[k][order[s]] for s in slots])


def test_small_thresholds_keep_a_table(spark, tmp_path):
    df = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("v"), F.col("id") % 1500)).otherwise(F.concat(F.lit("one"), F.col("id"))).alias("t"), F.lit(None).cast("string").alias("u"))
    fitted = encode.fit_frequent_labels(df, 0.0005, columns=["t", "u"])
    assert fitted.table is not None and fitted.table.count() == 750
    got = encode.apply_frequent_labels(df, fitted)
    assert got.columns == df.columns and got.where("t = 'Other'").count() == 3000 and got.where("u = 'Other'").count() == 6000
    model = stages.RareLabelCollapser(threshold=0.0005).fit(df)
    model.write().overwrite().save(f"{tmp_path}/r")
    assert stages.RareLabelCollapserModel.load(f"{tmp_path}/r").transform(df).where("t = 'Other'").count() == 3000


def test_prepare_takes_free_text(spark, sales, monkeypatch):
    """A text column with a label a row does not stop the preparation; the others are encoded as without it."""
    plain = preprocess.prepare(sales)
    monkeypatch.setattr(encode.fit_indicators, "__defaults__", (None, 40))
    noted = preprocess.prepare(sales.withColumn("Note", F.concat(F.lit("house "), F.col("PID").cast("string"))))
    assert noted.indicators.wide == ("Note",) and noted.features == plain.features
    rows = noted.table.join(noted.dictionary, F.array_contains("label_numbers", F.col("number")))
    assert rows.where("value <> concat('house ', PID)").count() == 0 and rows.count() == plain.table.count()
