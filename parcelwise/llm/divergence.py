"""How far the sources of a language differ in their use of words: exact divergence sums over run-length columns.

Every source of a language has one column of counts over the language's kept terms. The vocabulary is reordered so that
terms with the same counts everywhere fall together (one weighted entry) and neighbours have equal counts in most
columns; the order is cut into blocks and each source's column of a block is run-length encoded. For a pair of sources
the ends of both columns' runs are intersected, and each piece adds its divergence times its length. Long runs of zeros,
which make up most of a column, cost one step.

A task holds the columns of one block for two tiles of TILE sources, so its size is bounded at any number of sources,
documents or terms. Counts are combined in the tasks and by Spark before any shuffle by key, so one hot source is no problem; a
term's counts in all sources of its language are one row.

The divergence of two shares p, q (whole numbers, SCALE to one, smoothed by 2 a term) is floor((p - q)^2 / (p + q)). All
arithmetic is on whole numbers: 64-bit ones where they are proven wide enough, else decimals or Python's.

Defined results: null text, lang and source are ''; a language in which no term reaches the least number of documents has
V = 0 and pair sums of 0; a source alone in its language has no pairs; rows count as documents whatever their id, repeated
ones too; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelwise.llm.words import find_words, slices
from parcelwise.session import reliable

#: Words are runs of letters a to z and anything outside ASCII (texts are lower-cased first).
LETTERS = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
SCALE, PRIOR = 1_000_000_000, 2
LEAST_DOCUMENTS = 10
#: Entries of a block of the vocabulary, and sources whose columns meet in one task.
BLOCK, TILE = 8192, 48
#: Bytes of text whose terms are counted together in a task.
SLICE = 3 << 20


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each source of a language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                words = find_words(part.column(2), LETTERS, lower=True)
                if not len(words):
                    continue
                # all words side by side as one string column: their bytes are what the class lets through
                length = words.end - words.start
                offsets = np.zeros(len(words) + 1, np.int64)
                np.cumsum(length, out=offsets[1:])
                column = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(words.data[LETTERS[words.data]])))
                coded = column.dictionary_encode()
                codes, n_terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
                lang, source = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                rows = words.rows()
                by_row, n = np.unique(rows * n_terms + codes, return_counts=True)
                key = group[by_row // n_terms] * n_terms + by_row % n_terms
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                of, term = key[first] // n_terms, key[first] % n_terms
                yield pa.RecordBatch.from_arrays([
                    lang.dictionary.take(pa.array(of // len(source.dictionary))), source.dictionary.take(pa.array(of % len(source.dictionary))),
                    coded.dictionary.take(pa.array(term)).cast(pa.string()), pa.array(np.add.reduceat(n, first)), pa.array(np.diff(np.append(first, len(key)))),
                ], names=["lang", "source", "term", "n", "docs"])

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.mapInArrow(work, "lang string, source string, term string, n bigint, docs bigint").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts): kept terms, and their counts by source, sorted by source."""
    return counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts")
    ).where(F.col("docs") >= least).select("lang", "term", "total", "counts")


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``; the product is a decimal, so nothing overflows."""
    above, below = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE), (total + PRIOR * terms).cast("decimal(20,0)")
    return (1 + F.call_function("div", above, below)).cast("long")


def divergence(p: Column, q: Column) -> Column:
    """The divergence of two shares of at most SCALE + 1: the square stays below 2**63."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def encode_block(ends: np.ndarray, entry: np.ndarray, source: np.ndarray, n: np.ndarray, n_sources: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first run of each source, ends of the runs, their counts) from the non-zero cells of a block.

    ``ends`` are the running weights of the block's entries; cells are (entry, source number, count). Neighbouring
    entries with one count are one run, and so are those between without a cell, with count 0.
    """
    order = np.lexsort((entry, source))
    entry, source, n = entry[order], source[order], n[order]
    begins = np.append(True, (source[1:] != source[:-1]) | (entry[1:] != entry[:-1] + 1) | (n[1:] != n[:-1]))
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(entry)) - 1
    of, stop = source[first], ends[entry[last]]
    start = np.where(entry[first] > 0, ends[entry[first] - 1], 0)
    new_column = np.append(True, of[1:] != of[:-1])
    before = np.where(new_column, 0, np.append(0, stop[:-1]))
    gap = start > before  # zeros before the run
    closing = np.flatnonzero(np.append(new_column[1:], True))
    tail = closing[stop[closing] < ends[-1]]  # zeros after a column's last run
    of = np.concatenate([of, of[gap], of[tail]])
    stop = np.concatenate([stop, start[gap], np.full(len(tail), ends[-1])])
    value = np.concatenate([n[first], np.zeros(gap.sum() + len(tail), np.int64)])
    order = np.lexsort((stop, of))
    return np.searchsorted(of[order], np.arange(n_sources + 1)), stop[order], value[order]


def runs(kept: DataFrame) -> DataFrame:
    """(lang, block, source, length, ends, counts): run-length columns of the reordered vocabulary.

    Terms with equal counts everywhere are one entry of that weight. Entries are ordered by how many sources have
    them and by their counts; a block is a piece of that order. ``length`` is the number of terms in the block. A source
    has a column where it has a count above 0.
    """
    entries = kept.groupBy("lang", "counts").agg(F.count("*").alias("weight"))
    keys = ["lang", F.size("counts"), "counts"]
    ordered = entries.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero(langs[1:] != langs[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(langs)]):
                for at in range(a, b, BLOCK):
                    part = batch.slice(at, min(b, at + BLOCK) - at)
                    lists, ends = part.column(1), np.cumsum(part.column(2).to_numpy())
                    cells = lists.flatten()
                    names = cells.field("source").dictionary_encode()
                    sizes = np.diff(lists.offsets.to_numpy())
                    first, stop, value = encode_block(
                        ends, np.repeat(np.arange(len(sizes)), sizes), names.indices.to_numpy().astype(np.int64), cells.field("n").to_numpy(), len(names.dictionary)
                    )
                    columns, offsets = len(names.dictionary), pa.array(first.astype(np.int32))
                    number += 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part.column(0)[0].as_py()] * columns), pa.array([f"{TaskContext.get().partitionId()}-{number}"] * columns), names.dictionary,
                        pa.array(np.full(columns, ends[-1])), pa.ListArray.from_arrays(offsets, pa.array(stop)), pa.ListArray.from_arrays(offsets, pa.array(value)),
                    ], names=["lang", "block", "source", "length", "ends", "counts"])

    return ordered.select("lang", "counts", "weight").mapInArrow(work, "lang string, block string, source string, length bigint, ends array<bigint>, counts array<bigint>")


def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``, in 64 bits where the product fits."""
    below = total + PRIOR * terms
    if len(n) and int(n.max()) + PRIOR >= (1 << 63) // SCALE:
        return np.array([1 + SCALE * (int(x) + PRIOR) // below for x in n], np.int64)
    return 1 + SCALE * (n + PRIOR) // below


def run_divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of the divergences of two run-length columns of shares (ends, shares) over the same terms."""
    ends = np.unique(np.concatenate([a[0], b[0]]))
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    return int(((p - q) * (p - q) // (p + q) * np.diff(ends, prepend=0)).sum())


def pair_sums(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) for each two sources of a language, both ways round.

    ``groups``: (lang, source, total, terms) of every source. All meet in every block, those without a column there with zeros.
    """
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    placed = groups.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
    empty = groups.select("lang", F.lit("").alias("block"), F.lit(0).cast("long").alias("length"))
    blocks = columns.select("lang", "block", "length").unionByName(empty).distinct()
    every = blocks.join(placed, "lang").join(columns.drop("length"), ["lang", "block", "source"], "left")
    dealt = every.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))

    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        held = []
        for row in rows:
            ends = np.array(row["ends"] if row["ends"] is not None else [row["length"]] if row["length"] else [], np.int64)
            counts = np.array(row["counts"] if row["counts"] is not None else [0] * len(ends), np.int64)
            held.append((row["source"], row["tile"], (ends, shares(counts, row["total"], row["terms"]) if len(ends) else counts)))
        held.sort(key=lambda x: (x[1], x[0]))
        lang, across = (rows[0]["lang"], rows[0]["low"] != rows[0]["high"])
        found = [(a[0], b[0], run_divergence(a[2], b[2])) for i, a in enumerate(held) for b in held[i + 1 :] if not across or a[1] != b[1]]
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "source": pa.array([x[0] for x in found], pa.string()),
                         "other": pa.array([x[1] for x in found], pa.string()), "value": pa.array([x[2] for x in found], pa.int64())})

    needed = dealt.select("lang", "block", "low", "high", "source", "tile", "total", "terms", "length", "ends", "counts")
    sums = needed.groupBy("lang", "block", "low", "high").applyInArrow(work, "lang string, source string, other string, value bigint")
    sums = sums.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    return sums.select("lang", "value", both.alias("pair")).select("lang", "pair.source", "pair.item", "value")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from each other source, and the words most overused in a source.

    Part ``pair`` lists all other sources of the language, ``term`` the ``top`` kept terms whose share in the source is above that
    in the language; greater values first, then by item.
    """
    kept = reliable(vocabulary(term_counts(docs, text_col, lang_col, source_col), least))
    cells = kept.select("lang", "term", "total", F.inline("counts"))
    by_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("terms"))
    occurring = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    groups = reliable(occurring.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0, ["total", "lang_total", "terms"]))
    pairs = pair_sums(reliable(runs(kept)), groups.select("lang", "source", "total", "terms"))
    shared = cells.withColumnRenamed("total", "in_lang").join(groups, ["lang", "source"])
    shared = shared.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"))
    over = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
