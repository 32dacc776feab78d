"""From raw documents to packed training sequences, stage by stage.

Each stage takes all its predecessor kept and returns the columns of ``documents``; the last returns the packed pieces.
Rows are addressed by doc_id together with a hash of the text, ids may be null or repeated. Null and empty texts pass the stages
that look for copies and passages; the classifier judges them like others. Empty tables give empty results; extra columns
are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwise.llm import compression_quality, curve_packing, ngram_join, super_kmers, winnowing
from parcelwise.session import scratch_dir


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; learned from the labels of the documents at hand."""
    model = compression_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression_quality.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays; of equal rows one."""
    return ngram_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the first document that has them."""
    done = super_kmers.cut_repeats(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = winnowing.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(docs["text"]) == F.col("hit_key")), "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 4096, like documents together."""
    return curve_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("near_copies", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
#: The classifier and the packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder, as the next one reads them several times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
