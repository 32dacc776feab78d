"""Benchmark decontamination by winnowing: shared fingerprints find the places, word by word extension decides.

A text's fingerprints are the rightmost least of every ``STEPS`` consecutive hashes of ``GRAM`` words, so two texts that
share GRAM + STEPS - 1 = 10 words in a row share a fingerprint inside them. Items of fewer than 10 words are one gram of
their own length; documents take all grams of the lengths that occur (nine at most).

Documents are read once. A bitmap of the items' fingerprints, of bounded size, thins out the documents' fingerprints
before they leave their task; what passes carries the words within 5 of the gram, enough to try every window of 10 that
holds it. The join on the fingerprint then compares the words themselves, so hashes decide nothing. Items may be few
or many: Spark sends the smaller side or shuffles both. Items with one and the same passage are told apart only by the
list of ids at the end.

Defined results: a null, empty or wordless text has no words and no hits, and such an item occurs nowhere; items with null
id are left out; an item id given twice stands for both texts; a null doc_id is an id like any other; each input row gives
one result row; empty tables give no hits; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelwise.llm.bitmaps import bitmap, passes
from parcelwise.llm.words import PLAIN, Words, find_words, grams, mix, slices
from parcelwise.session import reliable

GRAM, STEPS = 5, 6
SPAN = GRAM + STEPS - 1


def winnow(words: Words, hashes: np.ndarray, k: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, fingerprint) of the selected k-grams; windows of grams stay inside their text."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = mix(grams(hashes, k) + np.uint64(k))
    ends = np.repeat(words.first[1:], words.counts)
    best = np.flatnonzero(np.arange(len(h)) + k + steps - 1 <= ends)
    least, begin = h[best], best
    for j in range(1, steps):
        later = h[begin + j]
        better = later <= least
        best, least = np.where(better, begin + j, best), np.where(better, later, least)
    chosen = np.zeros(len(h), bool)
    chosen[best] = True
    at = np.flatnonzero(chosen)
    return at, h[at]


def _surroundings(words: Words, at: np.ndarray, k: int, row: np.ndarray) -> list[pa.Array]:
    """For each gram its words as one string, the words before it, nearest first, and those after it, as far as a window reaches."""
    data = words.data.tobytes()
    start, end = words.start, words.end
    reach = max(0, SPAN - k) if k == GRAM else 0
    mid, before, after = [], [], []
    for i, r in zip(at, row):
        low, high = words.first[r], words.first[r + 1]
        w = [data[start[j] : end[j]].decode() for j in range(max(low, i - reach), min(high, i + k + reach))]
        b = min(reach, i - low)
        mid.append(" ".join(w[b : b + k]))
        before.append(w[:b][::-1])
        after.append(w[b + k :])
    strings = pa.list_(pa.string())
    return [pa.array(mid, pa.string()), pa.array(before, strings), pa.array(after, strings)]


GRAM_FIELDS = "pos:int,fp:bigint,k:int,mid:string,before:array<string>,after:array<string>"


def _gram_rows(words: Words, picks: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.ListArray:
    """The picked grams of each text as a list of structs."""
    rows = words.rows()
    parts = []
    for at, fp, k in picks:
        row = rows[at]
        fields = [pa.array((at - words.first[row]).astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(np.full(len(at), k, np.int32)), *_surroundings(words, at, k, row)]
        parts.append((row, pa.StructArray.from_arrays(fields, names=["pos", "fp", "k", "mid", "before", "after"])))
    row = np.concatenate([r for r, _ in parts])
    order = np.argsort(row, kind="stable")
    values = pa.concat_arrays([s for _, s in parts]).take(pa.array(order))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(len(words.first))).astype(np.int32)), values)


def item_grams(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(fp, k, mid, before, after, items): the items' fingerprints; ``items`` are the ids with one and the same surroundings."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words = find_words(part.column(1), PLAIN, lower=True)
                hashes, rows, counts = words.hashes(), words.rows(), words.counts
                at, fp = winnow(words, hashes, GRAM, STEPS)
                picks = [(at, fp, GRAM)]
                for k in np.unique(counts[(counts > 0) & (counts < SPAN)]):
                    at, fp = winnow(words, hashes, int(k), 1)
                    whole = counts[rows[at]] == k
                    picks.append((at[whole], fp[whole], int(k)))
                yield pa.RecordBatch.from_arrays([part.column(0), _gram_rows(words, picks)], names=["item_id", "grams"])

    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).where("item_id IS NOT NULL")
    found = rows.mapInArrow(pick, f"item_id string, grams array<struct<{GRAM_FIELDS}>>")
    found = found.select("item_id", F.inline("grams")).groupBy("fp", "k", "mid", "before", "after")
    return found.agg(F.collect_set("item_id").alias("items"))


def _alike(a: Column, b: Column) -> Column:
    """How many words two arrays have in common before they first differ."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: ~F.coalesce(x == y, F.lit(False))), True)
    return F.when(differs == 0, F.least(F.size(a), F.size(b))).otherwise(differs - 1).cast("int")


def _covered(spans: Column) -> Column:
    """Words in the union of sorted spans."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(
        spans, none,
        lambda a, s: F.struct(F.greatest(a["end"], s["stop"]).alias("end"), (a["total"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["end"], s["start"]))).alias("total")),
    )["total"]


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, spans, items) of every document.

    ``spans``: the hit words as sorted (start, stop) pairs, which may overlap; ``items``: ids, sorted as strings.
    ``text_key`` is a hash of the text: with doc_id it leads back to the rows of ``docs``.
    """
    known = reliable(item_grams(items, item_col, item_text_col))
    lengths = sorted((r["k"], r["n"]) for r in known.groupBy("k").agg(F.count("*").alias("n")).collect())
    # items of five words share the gram length of the winnowed ones and are sought at every place as well
    every = sorted({k for k, _ in lengths if k != GRAM} | ({GRAM} if _has_short_of(known) else set()))
    seen = bitmap(known, "fp", sum(n for _, n in lengths))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                words = find_words(part.column(2), PLAIN, lower=True)
                hashes = words.hashes()
                picks = []
                for k, steps in [(k, 1) for k in every] if GRAM in every else [(GRAM, STEPS), *[(k, 1) for k in every]]:
                    at, fp = winnow(words, hashes, k, steps)
                    likely = passes(seen.value, fp)
                    picks.append((at[likely], fp[likely], k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.counts.astype(np.int64)), _gram_rows(words, picks)], names=["doc_id", "text_key", "n_words", "grams"]
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = reliable(rows.mapInArrow(pick, f"doc_id {id_type}, text_key bigint, n_words bigint, grams array<struct<{GRAM_FIELDS}>>"))
    places = read.where(F.size("grams") > 0).select("doc_id", "text_key", F.inline("grams")).alias("d")
    met = places.join(known.alias("i"), ["fp", "k", "mid"]).select(
        "doc_id", "text_key", "pos", "k", "items",
        _alike(F.col("d.before"), F.col("i.before")).alias("b"), _alike(F.col("d.after"), F.col("i.after")).alias("a"),
        F.col("i.before").alias("ib"), F.col("i.after").alias("ia"),
    )
    # a whole short item, or ten words and more around the gram
    whole = (F.size("ib") == 0) & (F.size("ia") == 0)
    met = met.where(whole | (F.col("k") + F.col("b") + F.col("a") >= SPAN))
    hits = met.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct((F.col("pos") - F.col("b")).alias("start"), (F.col("pos") + F.col("k") + F.col("a")).alias("stop")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "spans", "items")
    same = read["doc_id"].eqNullSafe(hits["hit_id"]) & (read["text_key"] == hits["hit_key"])
    return read.join(hits, same, "left").select(
        "doc_id", "text_key", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _has_short_of(known: DataFrame) -> bool:
    """Is there an item of exactly GRAM words?"""
    return bool(known.where((F.col("k") == GRAM) & (F.size("before") == 0) & (F.size("after") == 0)).limit(1).count())
