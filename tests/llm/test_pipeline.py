"""The pipeline's stages take effect and leave clean documents alone."""

import corpus_pipeline
from parcelwise.llm.queries import QUERIES, SQL
from tests.llm.test_tables import brute_groups, brute_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(i, t) for i, t in kept.items()]
        docs = stage(spark, spark.createDataFrame(docs.collect(), docs.schema), SF)
        assert docs.columns == columns
        kept = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(kept) <= {i for i, _ in before} and kept
        if name == "near_copies":
            assert set(kept) == {i for i, _, least in map(eval, brute_groups(before)) if i == least}
        if name == "decontamination":
            assert set(kept) == {i for i, t in before if not brute_hits(t, items)[1]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    def pieces(df):
        return sorted((r["doc_id"], r["doc_tokens"]) for r in df.groupBy("doc_id", "doc_tokens").count().collect())
    assert pieces(corpus_pipeline.run(spark, SF)) == pieces(docs)


def odd_documents(spark):
    """Repeated rows, one id for two texts, null ids, null and empty texts, and columns with names that stages use inside."""
    text, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "wot")
    rows = [(1, text), (1, text), (2, text), (2, other), (None, text), (None, other + " x"), (None, None), (3, None), (3, None), (4, " "), (None, third), (None, third)]
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS __id", "'zz' AS class", "2 AS rows"), text, other, third


def test_near_copies_with_odd_ids(spark):
    docs, text, other, third = odd_documents(spark)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, text), (2, other), (None, third), (None, None), (3, None), (3, None), (4, " ")], key=repr)


def test_stages_take_odd_and_empty_tables(spark):
    docs, *_ = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[1:]:
        done = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "packing":
            assert done.columns == docs.columns
            docs = spark.createDataFrame(done.collect(), docs.schema)
    assert done.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
