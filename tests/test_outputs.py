"""Quarantined CSV rows, outputs that appear at once, stamps that repeat."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from parcelwise.plans import preprocess, scoring
from parcelwise.sources import quarantine, versions
from parcelwise.streaming.score_stream import read_scored

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("d", T.DateType())])


def test_bad_rows_come_back_with_file_and_reason(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,c\n1,2.5,x\n2,oops,y\n3,4\n4,5,z,more\n"5",NA,"q,r"\n,,\n')
    (tmp_path / "two.csv").write_text("a,b,c\n9999999999999999999,1,w\n7,1e3,v\n")
    good, bad = quarantine.read_csv_with_quarantine(spark, str(tmp_path), SCHEMA)
    assert good.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "date")]
    assert sorted(((r["a"], r["b"], r["c"]) for r in good.collect()), key=repr) == sorted([(1, 2.5, "x"), (5, None, "q,r"), (None, None, None), (7, 1000.0, "v")], key=repr)
    got = sorted((r["file"].rsplit("/", 1)[1], r["record"], [(x["column"], x["check"], x["value"]) for x in r["reasons"]]) for r in bad.collect())
    ragged = [(None, "as many cells as the header", None)]
    assert got == [("one.csv", "2,oops,y", [("b", "is double", "oops")]), ("one.csv", "3,4", ragged), ("one.csv", "4,5,z,more", ragged),
                   ("two.csv", "9999999999999999999,1,w", [("a", "is bigint", "9999999999999999999")])]


def test_a_broken_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "out")

    def write(n):
        return {"rows": lambda p: spark.range(n).write.parquet(p), "names": lambda p: spark.range(1).selectExpr(f"'{n}' AS x").write.text(p)}

    def read():
        return spark.read.parquet(versions.part_path(spark, path, "rows")).count(), spark.read.text(versions.part_path(spark, path, "names")).first()[0]

    with pytest.raises(FileNotFoundError):
        versions.part_path(spark, path, "rows")
    versions.write_version(spark, path, write(5))
    assert read() == (5, "5")

    def broken(p):
        spark.range(3).write.parquet(p)
        raise OSError("halfway")

    with pytest.raises(OSError):
        versions.write_version(spark, path, {"rows": write(9)["rows"], "names": broken})
    assert read() == (5, "5")
    versions.write_version(spark, path, write(7))
    assert read() == (7, "7") and versions.prune(spark, path) == 1 and versions.prune(spark, path) == 0 and read() == (7, "7")


def test_prepared_splits_are_one_version(spark, sales, tmp_path):
    csv, out = str(tmp_path / "csv"), str(tmp_path / "out")
    sales.write.option("header", True).option("nullValue", "NA").csv(csv)
    done = preprocess.run(spark, csv, out)
    n = [preprocess.read_prepared_split(spark, out, s).count() for s in ("train", "val", "test")]
    assert sum(n) == done.table.count() and preprocess.read_prepared_names(spark, out) == done.features
    with pytest.raises(ValueError):
        preprocess.read_prepared_split(spark, out, "other")


def test_ids_follow_from_run_and_key(spark):
    df = spark.range(50).select("id", (F.col("id") * 1.0).alias("prediction"))
    at = datetime(2024, 1, 2)

    def rows(run):
        return {r["id"]: (r["prediction_id"], r["timestamp"]) for r in scoring.price_columns(df.repartition(3), ["id"], log_target=False, run=run, at=at).collect()}

    one = rows("a")
    assert one == rows("a") and len({i for i, _ in one.values()}) == 50 and not {i for i, _ in one.values()} & {i for i, _ in rows("b").values()}
    assert all(len(i) == 36 and t == at for i, t in one.values())


def test_readers_see_complete_batches_only(spark, tmp_path):
    for batch, done in ((0, True), (1, False)):
        spark.range(4).write.parquet(f"{tmp_path}/scored/batch={batch}")
        if done:
            spark.range(1).selectExpr(f"{batch}L AS batch").write.parquet(f"{tmp_path}/commits/of={batch}")
    assert read_scored(spark, str(tmp_path)).count() == 4
