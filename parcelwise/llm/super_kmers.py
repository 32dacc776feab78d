"""Substring dedup: windows of words travel packed by minimiser, and each bucket sorts and compares them exactly.

1. Every window of ``span`` words has a minimiser, the least hash of its runs of ``MINIMISER`` words. Consecutive windows
   mostly share it; together they are one super-k-mer, ``span - 1`` words longer than it has windows. A first pass only counts:
   minimisers with their least and greatest document and how often they occur, combined in the task.
2. A second pass packs the super-k-mers whose minimiser occurs in two documents, each as one string, and sends it to its
   minimiser's bucket. (A bitmap of bounded size says which; what it lets through in vain finds no partner.)
3. A bucket numbers its words, then ranks runs of 1, 2, 4, ... words by sorting pairs of ranks, up to whole windows: equal rank
   means equal words, no hash decides. Windows that a smaller document has as well are marked. Task memory: buckets are worked off in
   portions of ``PORTION`` words.
4. A minimiser that occurs ``least_heavy`` times or more would make a large bucket; the bound is the same at any input. Its
   super-k-mers are keyed by a 128-bit cryptographic digest of their words instead: the
   least document of a key is found with map-side combining and joined back, where Spark may split a hot key. Copies are
   settled by that; the different super-k-mers that remain are cut finer, those whose finer minimiser two documents share are compared in the same
   way, and at last their windows. Which minimisers these are is told by a second bitmap, as their number grows with the input;
   one that it lets through in vain goes this way as well, with the same result.
5. Marks are gathered by document and joined to the texts, the only shuffle of whole texts.

Documents are told apart by doc_id; ids that are not whole numbers are first given numbers in their order. Defined results: a null text has no words; texts of fewer than ``span`` words are
left as they are; a row with null doc_id neither takes nor gives; rows that share a doc_id are one document and do not take
from each other; each input row gives one result row; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from parcelwise.llm.bitmaps import bitmap, passes
from parcelwise.llm.words import SPACED, Words, find_words, grams, slices
from parcelwise.operators.label_numbers import numbered
from parcelwise.session import reliable

MINIMISER = 8
HEAVY = 1024
PORTION = 1 << 20
#: Words of the finer minimisers, in percent of the span.
FINER = 64


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on; the last width - 1 places see fewer."""
    done = 1
    while done < width:
        step = min(done, width - done)
        later = x[step:]
        x = np.concatenate((np.minimum(x[: len(later)], later), x[len(later) :]))
        done += step
    return x


def super_kmers(words: Words, span: int, m: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the first window, number of windows, minimiser of m words) of every run of windows within a text."""
    m = min(m, span)
    least = sliding_least(grams(words.hashes(), m), span - m + 1)
    rows = words.rows()
    window = np.flatnonzero(np.arange(len(words)) + span <= words.first[1:][rows]) if len(words) else np.zeros(0, np.int64)
    if not len(window):
        return window, window, np.zeros(0, np.uint64)
    value, row = least[window], rows[window]
    turn = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1]))))
    return window[turn], np.diff(np.append(turn, len(window))), value[turn]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """Slices of (doc_id, text_key, text) with their words and ids."""
    for batch in batches:
        for part in slices(batch, 2):
            yield part, find_words(part.column(2), SPACED), part.column(0).to_numpy(zero_copy_only=False)


def _minimisers(rows: DataFrame, span: int) -> DataFrame:
    """(minimiser, low, high, n): the least and greatest document of every minimiser and its occurrences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, ids in _parts(batches):
            at, _, value = super_kmers(words, span)
            doc = ids[words.rows()[at]] if len(at) else np.zeros(0, np.int64)
            order = np.lexsort((doc, value))
            value, doc = value[order], doc[order]
            begin = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
            stop = np.append(begin[1:], len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[begin].view(np.int64)), pa.array(doc[begin]), pa.array(doc[stop - 1] if len(begin) else doc), pa.array(stop[: len(begin)] - begin)],
                names=["minimiser", "low", "high", "n"],
            )

    found = rows.mapInArrow(scan, "minimiser bigint, low bigint, high bigint, n bigint")
    return found.groupBy("minimiser").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


def _packed(rows: DataFrame, span: int, shared, heavy) -> DataFrame:
    """(minimiser, doc_id, text_key, start, windows, words) of the super-k-mers that may have a partner."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, ids in _parts(batches):
            at, size, value = super_kmers(words, span)
            use = passes(shared.value, value) & ~passes(heavy.value, value)
            at, size, value = at[use], size[use], value[use]
            row = words.rows()[at] if len(at) else at
            data = words.data.tobytes()
            text = [data[a:b] for a, b in zip(words.start[at], words.end[at + size + span - 2])]
            key = part.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(ids[row]), pa.array(key[row]), pa.array((at - words.first[row]).astype(np.int64)), pa.array(size), pa.array(text, pa.binary())],
                names=["minimiser", "doc_id", "text_key", "start", "windows", "words"],
            )

    return rows.mapInArrow(scan, "minimiser bigint, doc_id bigint, text_key bigint, start bigint, windows bigint, words binary")


def _digests(texts: list[bytes]) -> list[pa.Array]:
    """Two halves of a 128-bit cryptographic digest of each text's words."""
    d = np.frombuffer(b"".join(hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in texts), "<i8").reshape(-1, 2)
    return [pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())]


def _heavy_runs(rows: DataFrame, span: int, shared, heavy) -> DataFrame:
    """(d1, d2, doc_id, text_key, start, windows, words) of the super-k-mers of heavy minimisers, with a digest of their words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, ids in _parts(batches):
            at, size, value = super_kmers(words, span)
            use = passes(shared.value, value) & passes(heavy.value, value)
            at, size = at[use], size[use]
            row = words.rows()[at] if len(at) else at
            data = words.data.tobytes()
            text = [data[a:b] for a, b in zip(words.start[at], words.end[at + size + span - 2])]
            key = part.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*_digests(text), pa.array(ids[row]), pa.array(key[row]), pa.array((at - words.first[row]).astype(np.int64)), pa.array(size), pa.array(text, pa.binary())],
                names=["d1", "d2", "doc_id", "text_key", "start", "windows", "words"],
            )

    return rows.mapInArrow(scan, "d1 bigint, d2 bigint, doc_id bigint, text_key bigint, start bigint, windows bigint, words binary")


def _pieces(runs: DataFrame, span: int, m: int) -> DataFrame:
    """The same columns for super-k-mers cut into those of minimisers of m words; with m = span, into single windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = find_words(batch.column(4).cast(pa.string()), SPACED)
            at, size, value = super_kmers(words, span, m)
            if m == span:  # equal windows in a row are one run, but have to be told apart
                stops = np.cumsum(size)
                at, value = np.repeat(at - (stops - size), size) + np.arange(size.sum()), np.repeat(value, size)
                size = np.ones(len(at), np.int64)
            row = words.rows()[at] if len(at) else at
            data = words.data.tobytes()
            text = [data[a:b] for a, b in zip(words.start[at], words.end[at + size + span - 2])]
            doc, key, start = (batch.column(i).to_numpy()[row] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [*_digests(text), pa.array(doc), pa.array(key), pa.array(start + at - words.first[row]), pa.array(size), pa.array(text, pa.binary()), pa.array(value.view(np.int64))],
                names=["d1", "d2", "doc_id", "text_key", "start", "windows", "words", "minimiser"],
            )

    whole = runs.select("doc_id", "text_key", "start", "windows", "words")
    cut = whole.mapInArrow(scan, "d1 bigint, d2 bigint, doc_id bigint, text_key bigint, start bigint, windows bigint, words binary, minimiser bigint")
    if m == span:
        return cut
    # a finer minimiser of one document only has no window that another has
    cut = reliable(cut)
    met = cut.groupBy("minimiser").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("minimiser")
    return cut.join(met, "minimiser", "left_semi")


def _heavy_marks(rows: DataFrame, span: int, shared, heavy) -> DataFrame:
    """Marks for the windows of heavy minimisers.

    Whole super-k-mers first: all windows of one that a smaller document has word for word are marked at once, so copies cost
    a row a super-k-mer. What is left, one document for each different super-k-mer, is cut finer and compared again, and at
    last window by window. At each step equal pieces are settled by their least document, which goes on for all of them.
    """
    marks, left = None, _heavy_runs(rows, span, shared, heavy)
    for finer in (FINER * span // 100, span, None):
        left = reliable(left)
        least = left.groupBy("d1", "d2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        if finer is None:
            placed = left.join(least.where("least < most").drop("most"), ["d1", "d2"])
        else:
            placed = reliable(left.join(least.drop("most"), ["d1", "d2"]))
        found = placed.where("doc_id > least").select("doc_id", "text_key", "start", "windows")
        marks = found if marks is None else marks.union(found)
        if finer is not None:
            left = _pieces(placed.where("doc_id = least"), span, finer)
    return marks


def window_ranks(codes: np.ndarray, span: int) -> np.ndarray:
    """A number for the ``span`` codes from each place on, equal exactly where the codes are; the last span - 1 are meaningless."""
    rank, length = codes.astype(np.int64), 1
    while length < span:
        step = min(length, span - length)
        later = np.concatenate((rank[step:], np.zeros(step, np.int64)))[: len(rank)]
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + later, return_inverse=True)
        length += step
    return rank


def _marks(portion: pa.Table, span: int) -> pa.RecordBatch:
    """The runs of windows that a smaller document of the portion has as well."""
    texts = portion.column("words").combine_chunks().cast(pa.string())
    words = find_words(texts, SPACED)
    offsets = np.concatenate(([0], np.cumsum(words.end - words.start)))
    data = np.ascontiguousarray(words.data[SPACED[words.data]])
    codes = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).dictionary_encode().indices
    rank = window_ranks(codes.to_numpy(zero_copy_only=False), span)
    size = portion.column("windows").to_numpy()
    stops = np.cumsum(size)
    row = np.repeat(np.arange(len(size)), size)
    at = np.repeat(words.first[:-1] - (stops - size), size) + np.arange(len(row))
    doc = portion.column("doc_id").to_numpy()[row]
    rank = rank[at]
    order = np.lexsort((doc, rank))
    turn = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    least = doc[order][turn][np.cumsum(turn) - 1]
    mark = np.zeros(len(row), bool)
    mark[order] = doc[order] > least
    place = np.arange(len(row)) - (stops - size)[row] + portion.column("start").to_numpy()[row]
    hit = np.flatnonzero(mark)
    begin = np.flatnonzero(np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (row[hit][1:] != row[hit][:-1])))) if len(hit) else hit
    first = hit[begin]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[first]), pa.array(portion.column("text_key").to_numpy()[row[first]]), pa.array(place[first]), pa.array(np.diff(np.append(begin, len(hit))))],
        names=["doc_id", "text_key", "start", "windows"],
    )


def _bucket_marks(packed: DataFrame, span: int, portion: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            value = batch.column(0).to_numpy()
            words = batch.column(4).to_numpy() + span - 1
            at = 0
            while at < len(value):
                # up to the end of the bucket that fills the portion
                to = int(np.searchsorted(np.cumsum(words[at:]), portion - n)) + at
                to = min(to, len(value) - 1)
                stop = int(np.searchsorted(value, value[to], side="right")) if to < len(value) else len(value)
                held.append(batch.slice(at, stop - at))
                n += int(words[at:stop].sum())
                at = stop
                if n >= portion and at < len(value):
                    yield _marks(pa.Table.from_batches(held), span)
                    held, n = [], 0
            if n >= portion and held:
                # the last bucket may go on in the next batch
                table = pa.Table.from_batches(held)
                whole = int(np.searchsorted(table.column("minimiser").to_numpy(), value[-1], side="left"))
                if whole:
                    yield _marks(table.slice(0, whole), span)
                    held = table.slice(whole).to_batches()
                    n = sum(int(b.column(4).to_numpy().sum()) + b.num_rows * (span - 1) for b in held)
        if held:
            yield _marks(pa.Table.from_batches(held), span)

    dealt = packed.repartition("minimiser").sortWithinPartitions("minimiser")
    return dealt.mapInArrow(scan, "doc_id bigint, text_key bigint, start bigint, windows bigint")


def _numbered(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """``docs`` with a whole number for each id, in the order of the ids; null for null."""
    if isinstance(docs.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return docs.withColumn(name, F.col(id_col).cast("bigint"))
    ids = docs.select(F.col(id_col).alias("named_id")).where("named_id IS NOT NULL").distinct()
    ids = reliable(numbered(ids, ["named_id"], name))
    return docs.join(ids, docs[id_col] == F.col("named_id"), "left").drop("named_id")


def repeated_windows(docs: DataFrame, span: int = 50, id_col: str = "doc_id", text_col: str = "text", least_heavy: int = HEAVY, portion: int = PORTION) -> DataFrame:
    """(doc_id, text_key, runs): runs of windows, as (start, windows), that also start in a document with a smaller id, a whole number."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    counted = reliable(_minimisers(rows, span).where("low < high").select("minimiser", "n"))
    many = F.col("n") >= least_heavy
    different, heavies = counted.agg(F.count("*"), F.count_if(many)).first()
    shared = bitmap(counted, "minimiser", different)
    heavy = bitmap(counted.where(many), "minimiser", heavies)
    marks = _bucket_marks(_packed(rows, span, shared, heavy), span, portion)
    if heavies:
        marks = marks.union(_heavy_marks(rows, span, shared, heavy))
    return marks.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "windows"))).alias("runs"))


def _cut(starts, sizes, count: int, span: int) -> np.ndarray:
    """Which of a text's words are covered by none of the runs of windows."""
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes + span - 1, -1)
    return np.flatnonzero(np.cumsum(edge)[:-1] == 0)


def _with_runs(docs: DataFrame, span: int, id_col: str, text_col: str, least_heavy: int, portion: int = PORTION) -> DataFrame:
    """(row, text, start, windows): every row of ``docs`` as a struct, with its text's runs; null where there is none."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    rows = _numbered(rows, "id", "number")
    found = repeated_windows(rows, span, "number", "text", least_heavy, portion).select(F.col("doc_id").alias("run_id"), F.col("text_key").alias("run_key"), "runs")
    joined = rows.join(found, (F.col("number") == F.col("run_id")) & (F.col("text_key") == F.col("run_key")), "left")
    return joined.select("row", "text", "runs.start", "runs.windows")


def remove_repeats(
    docs: DataFrame, span: int = 50, id_col: str = "doc_id", text_col: str = "text", least_heavy: int = HEAVY, portion: int = PORTION
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; kept_sha256 is over the kept words joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words = find_words(part.column(1), SPACED)
                data, counts = words.data.tobytes(), words.counts
                removed, digests = [], []
                for i, (starts, sizes) in enumerate(zip(part.column(2), part.column(3))):
                    if not starts.is_valid:
                        kept = data[words.bounds[i] : words.bounds[i + 1]].split()
                    else:
                        stays = words.first[i] + _cut(np.asarray(starts.values), np.asarray(sizes.values), counts[i], span)
                        kept = [data[a:b] for a, b in zip(words.start[stays], words.end[stays])]
                    removed.append(int(counts[i]) - len(kept))
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    found = _with_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), span, "doc_id", "text", least_heavy, portion)
    found = found.select("row.doc_id", "text", "start", "windows")
    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(cut, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string")


def cut_repeats(docs: DataFrame, span: int = 50, id_col: str = "doc_id", text_col: str = "text", least_heavy: int = HEAVY) -> DataFrame:
    """``docs`` with all its columns, the repeated words cut from the text.

    Kept words keep the white space after them; untouched texts stay as they are; rows that lose all their words go.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words = find_words(part.column(1), SPACED)
                data, counts = words.data.tobytes(), words.counts
                following = np.concatenate((words.start[1:], [len(data)]))
                if len(words):
                    following = np.minimum(following, words.bounds[1:][words.rows()])
                kept: list[str | None] = []
                for i, (text, starts, sizes) in enumerate(zip(part.column(1), part.column(2), part.column(3))):
                    if not starts.is_valid:
                        kept.append(text.as_py())
                        continue
                    stays = words.first[i] + _cut(np.asarray(starts.values), np.asarray(sizes.values), counts[i], span)
                    kept.append(b"".join(data[a:b] for a, b in zip(words.start[stays], following[stays])).decode())
                done = pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.string())], names=["row", "text"])
                yield done.filter(pa.array([not s.is_valid or k != "" for s, k in zip(part.column(2), kept)], pa.bool_()))

    found = _with_runs(docs, span, id_col, text_col, least_heavy)
    row_type = found.schema["row"].dataType.simpleString()
    done = found.mapInArrow(cut, f"row {row_type}, text string")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
