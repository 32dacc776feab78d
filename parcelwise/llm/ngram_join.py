"""Jaccard join on word n-grams with a vertically partitioned order, and the groups its links form.

1. Every text becomes its set of n-gram hashes. Equal sets are one *class* from here on, so thousands of copies cost what
   one costs. Tasks also count n-grams in ``SLOTS`` hashed slots; summed up they give one global order, rare slots first,
   of bounded size. Any order gives right results; this one keeps phrases that many texts share out of the prefixes.
2. Two sets with Jaccard t or more share an n-gram among the first n - ceil(t n) + 1 of each. Those prefixes are
   shuffled by n-gram; n-grams with one class only drop out.
3. A set's counts in ``PARTS`` ranges of the hash bound every overlap: no more than the lesser count in each range can be
   common. Most candidates that share some n-gram by chance fall by that bound before any set is sent.
   The others are verified by fragments: the order is cut into ``FRAGMENTS`` ranges, each set into segments, the overlap of
   two segments is counted by itself (``array_intersect``), and partial overlaps are summed by pair.
4. A pair is formed under an n-gram only if the ranks of that n-gram in both sets leave the similarity possible, were it the
   first they share; so near copies with many changes do not meet under the n-grams that all have.
5. Links are sought in rounds, each among what shares a prefix n-gram but not yet a component. First every class is tested against
   one other: of those in which an n-gram of its prefix ranks first, the one where that rank is least (of near copies, one with few
   changes, the same for nearly all). Then against each n-gram's first and its neighbour in size: linear in the rows. Then all pairs
   that are left and fit in size. A pair within one component is never needed, so a large group of near copies is not spelled out, and
   no link between two groups can be missed.

Set members are 64-bit hashes, classes 128-bit sums over them.

Defined results: a null or wordless text has an empty set, no links, and is its own component; a text of fewer words
than n is one n-gram; rows with null id get links like others but do not name a component (one of null ids only has a null
name); repeated rows get equal results; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelwise.llm.bitmaps import bitmap, passes
from parcelwise.llm.components import components, few
from parcelwise.llm.words import SPACED, find_words, grams, mix, slices
from parcelwise.session import reliable

SLOTS = 1 << 16
FRAGMENTS = 8
#: Parts of the hash range whose counts bound an overlap from above, one byte each; FULL stands for itself and more.
PARTS, FULL = 256, 255


def ngram_sets(texts: pa.Array, n: int, slot_counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, where each text begins): the distinct n-grams of each text, in the global order if the counts are given."""
    words = find_words(texts, SPACED, lower=True)
    hashes, counts = words.hashes(), words.counts
    value = mix(grams(hashes, n) + np.uint64(n))
    rows = words.rows()
    valid = np.arange(len(value)) + n <= words.first[1:][rows]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            at = words.first[short]
            value[at] = mix(grams(hashes, k)[at] + np.uint64(k))
            valid[at] = True
    value, rows = value[valid], rows[valid]
    keys = (value, rows) if slot_counts is None else (value, slot_counts[value >> np.uint64(48)], rows)
    order = np.lexsort(keys)
    value, rows = value[order], rows[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.searchsorted(rows, np.arange(len(counts) + 1))


def _class_keys(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    sums = []
    for salt in (0x1B873593, 0x85EBCA6B):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(salt)))))
        sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _part_counts(value: np.ndarray, first: np.ndarray) -> pa.Array:
    """The counts of each set's hashes by range."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    counts = np.bincount(rows * PARTS + (value >> np.uint64(24) & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS * (len(first) - 1))
    raw = np.minimum(counts, FULL).astype(np.uint8)
    offsets = np.arange(len(first), dtype=np.int32) * PARTS
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _read(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, size, c1, c2, parts, seen): a row for each document, and one with ``seen`` for the slots that a task has counted."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, np.int64)
        names = ["doc_id", "size", "c1", "c2", "parts", "seen"]
        for batch in batches:
            for part in slices(batch, 1):
                value, first = ngram_sets(part.column(1), n)
                seen += np.bincount((value >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
                c1, c2 = _class_keys(value, first)
                nothing = pa.nulls(part.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first)), pa.array(c1), pa.array(c2), _part_counts(value, first), nothing], names=names)
        if seen.any():
            ids = pa.nulls(1, id_arrow)
            zero = pa.array([0], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, zero, zero, zero, pa.nulls(1, pa.binary()), pa.array([seen], pa.list_(pa.int64()))], names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    id_arrow = docs.limit(0).select("doc_id").toArrow().schema.field(0).type
    return docs.mapInArrow(scan, f"doc_id {id_type}, size bigint, c1 bigint, c2 bigint, parts binary, seen array<bigint>")


def _prefixes(docs: DataFrame, n: int, percent: int, slots: Broadcast) -> DataFrame:
    """(gram, c1, c2, place): the first n-grams of every set, enough that linked sets share one; place is the set's size and the n-gram's rank in it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                value, first = ngram_sets(part.column(1), n, slots.value)
                c1, c2 = _class_keys(value, first)
                size = np.diff(first)
                length = np.where(size > 0, size - -(-size * percent // 100) + 1, 0)
                stops = np.cumsum(length)
                rank = np.arange(length.sum()) - np.repeat(stops - length, length)
                taken = value[np.repeat(first[:-1], length) + rank]
                place = np.repeat(size, length) << 32 | rank
                yield pa.RecordBatch.from_arrays(
                    [pa.array(taken.view(np.int64)), *(pa.array(np.repeat(x, length)) for x in (c1, c2)), pa.array(place)], names=["gram", "c1", "c2", "place"]
                )

    return docs.mapInArrow(scan, "gram bigint, c1 bigint, c2 bigint, place bigint")


def _may_reach(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those (a, b, na, nb) whose counts by range leave the similarity possible, with the documents that stand for them."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(x.as_py() for x in batch.column(name)), np.uint8).reshape(-1, PARTS) for name in ("parts_a", "parts_b"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
            most = np.where(((a == FULL) & (b == FULL)).any(axis=1), np.minimum(na, nb), most)
            yield batch.select(names).filter(pa.array(100 * most >= percent * (na + nb - most)))

    of_a = classes.select(F.col("c").alias("a"), F.col("parts").alias("parts_a"), F.col("stands").alias("stands_a"))
    of_b = classes.select(F.col("c").alias("b"), F.col("parts").alias("parts_b"), F.col("stands").alias("stands_b"))
    rows = pairs.count()
    joined = few(few(pairs.join(of_a, "a"), rows).join(of_b, "b"), rows).select("a", "b", "na", "nb", "stands_a", "stands_b", "parts_a", "parts_b")
    names = ["a", "b", "na", "nb", "stands_a", "stands_b"]
    return reliable(joined.mapInArrow(judge, joined.select(names).schema))


def _segments(docs: DataFrame, n: int, slots: Broadcast, pivots: np.ndarray, wanted: Broadcast) -> DataFrame:
    """(c, fragment, grams): the segments of the wanted classes, from the documents that stand for them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                value, first = ngram_sets(part.column(1), n, slots.value)
                c1, c2 = _class_keys(value, first)
                use = passes(wanted.value, (c1 ^ part.column(2).to_numpy()).view(np.uint64))
                rows = np.repeat(np.arange(len(c1)), np.diff(first))
                fragment = np.searchsorted(pivots, slots.value[value >> np.uint64(48)], side="right")
                inside = use[rows]
                rows, fragment, value = rows[inside], fragment[inside], value[inside]
                if not len(rows):
                    continue
                turn = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (fragment[1:] != fragment[:-1]))))
                lists = pa.ListArray.from_arrays(pa.array(np.append(turn, len(rows)).astype(np.int32)), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1[rows[turn]]), pa.array(c2[rows[turn]]), pa.array(fragment[turn].astype(np.int32)), lists], names=["c1", "c2", "fragment", "grams"]
                )

    found = docs.withColumn("id_hash", F.xxhash64("doc_id")).mapInArrow(scan, "c1 bigint, c2 bigint, fragment int, grams array<bigint>")
    return found.select(F.struct("c1", "c2").alias("c"), "fragment", "grams")


def _fits(x: Column, y: Column, percent: int) -> Column:
    """May two sets reach the similarity if this is the first n-gram that they share? What comes before it in either is not common."""
    most = F.least(x["size"] - x["rank"], y["size"] - y["rank"])
    return 100 * most >= percent * (x["size"] + y["size"] - most)


def _links(pairs: DataFrame, docs: DataFrame, n: int, percent: int, slots: Broadcast, pivots: np.ndarray) -> DataFrame:
    """(u, v) of those pairs whose overlap is large enough, counted fragment by fragment."""
    ends = pairs.select(F.expr("a.c1 ^ stands_a").alias("end")).union(pairs.select(F.expr("b.c1 ^ stands_b"))).distinct()
    segments = reliable(_segments(docs, n, slots, pivots, bitmap(ends, "end", ends.count())))
    pairs = pairs.select("a", "b", "na", "nb")
    rows, kept = FRAGMENTS * pairs.count(), segments.count()
    segments = few(segments, FRAGMENTS * kept)  # rows are lists
    of_b = few(pairs.join(segments.select(F.col("c").alias("b"), "fragment", F.col("grams").alias("of_b")), "b"), rows)
    both = few(of_b.join(segments.select(F.col("c").alias("a"), "fragment", F.col("grams").alias("of_a")), ["a", "fragment"]), rows)
    partial = both.select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("of_a", "of_b")).alias("overlap"))
    # a document given twice brings its segments twice
    partial = few(partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("overlap").alias("overlap")), rows)
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return reliable(summed.where(f"100 * overlap >= {percent} * (na + nb - overlap)").select(F.col("a").alias("u"), F.col("b").alias("v")))


def _ordered(p: str, q: str) -> list[Column]:
    """Columns of a pair of (c, size) structs, the lesser class first."""
    swap = F.col(f"{p}.c") > F.col(f"{q}.c")
    first, second = F.when(swap, F.col(q)).otherwise(F.col(p)), F.when(swap, F.col(p)).otherwise(F.col(q))
    return [first["c"].alias("a"), second["c"].alias("b"), first["size"].alias("na"), second["size"].alias("nb")]


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the groups that links of ``percent`` / 100 Jaccard similarity or more form."""
    return jaccard_classes(docs, id_col, text_col, n, percent).select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class, component, component_id) of every row.

    ``class`` is one value for equal sets and null for an empty one; ``component`` the least class that links reach, whatever the ids.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    read = reliable(_read(docs, n))
    rows = read.where("seen IS NULL").select("doc_id", "size", F.when(F.col("size") > 0, F.struct("c1", "c2")).alias("c"), "parts")
    classes = rows.where("c IS NOT NULL").groupBy("c", "parts").agg(F.min("doc_id").alias("least")).withColumn("stands", F.xxhash64("least"))
    counted = read.where("seen IS NOT NULL").select(F.posexplode("seen").alias("slot", "n")).where("n > 0").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot_counts = np.zeros(SLOTS, np.int64)
    slot_counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    slots = spark.sparkContext.broadcast(slot_counts)
    by_count = np.sort(slot_counts)
    load = np.cumsum(by_count)
    pivots = np.unique(by_count[np.searchsorted(load, [load[-1] * i / FRAGMENTS for i in range(1, FRAGMENTS)]).clip(0, SLOTS - 1)])

    same = Window.partitionBy("gram")
    shared = _prefixes(docs, n, percent, slots).select(
        "*", *[f(x).over(same).alias(f"{f.__name__}_{x}") for x in ("c1", "c2") for f in (F.min, F.max)]
    ).where("min_c1 < max_c1 OR min_c2 < max_c2")
    shared = reliable(shared.groupBy("gram", "c1", "c2").agg(F.first("place").alias("place")).select(
        "gram", F.struct(F.col("place").bitwiseAND(0xFFFFFFFF).alias("rank"), F.shiftright("place", 32).alias("size"), F.struct("c1", "c2").alias("c")).alias("x")
    ))

    n_shared = shared.count()
    shared = few(shared, n_shared)
    classes = reliable(classes)
    classes = few(classes, classes.count())
    by_size = same.orderBy("x.size", "x.c")
    edges = found = None
    tested: DataFrame | None = None

    def settle(pairs: DataFrame) -> None:
        """Test pairs of classes and join the components of those that link."""
        nonlocal edges, found, tested
        pairs = pairs.select(*_ordered("x", "y")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti").select("a", "b", "na", "nb")
        pairs = reliable(pairs)
        pairs = few(pairs, pairs.count())
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        likely = _may_reach(pairs, classes, percent)
        n_likely = likely.count()
        if n_likely:
            new = _links(few(likely, n_likely), docs, n, percent, slots, pivots)
            edges = new if edges is None else edges.union(new)
            found = components(edges)

    def apart(rows: DataFrame) -> DataFrame:
        """The rows of n-grams whose classes are not yet in one component, with the component."""
        if found is None:
            return rows.withColumn("component", F.col("x.c"))
        labelled = few(rows.drop("component"), n_shared).join(found.select(F.col("node").alias("c"), "component"), F.col("x.c") == F.col("c"), "left").select(
            "gram", "x", F.coalesce("component", "x.c").alias("component")
        )
        labelled = few(labelled, n_shared)
        return reliable(labelled.select("*", F.min("component").over(same).alias("low"), F.max("component").over(same).alias("high")).where("low < high").drop("low", "high"))

    fits = _fits(F.col("x"), F.col("y"), percent)
    first = shared.select("x", F.min("x").over(same).alias("y")).where("x.c <> y.c").where(fits)
    settle(first.groupBy("x.c").agg(F.first("x").alias("x"), F.min("y").alias("y")))

    left = apart(shared)
    both = F.struct("x", "component")
    near = left.select(both.alias("p"), F.min(both).over(same).alias("hub"), F.lag(both).over(by_size).alias("next"))
    near = near.select("p", F.explode(F.array("hub", "next")).alias("q")).where("q IS NOT NULL AND p.component <> q.component")
    settle(near.select("p.x", F.col("q.x").alias("y")).where(fits))

    left = apart(left)
    other = left.select("gram", F.col("x").alias("y"), F.col("component").alias("component_y"))
    settle(left.join(other, "gram").where("component <> component_y AND x.c < y.c").where(fits).select("x", "y"))

    if found is None:
        found = classes.select(F.col("c").alias("node"), F.col("c").alias("component")).limit(0)
    named = classes.select("c", "least").join(found.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("c", "component", "component_id")
    return rows.join(named, "c", "left").select("doc_id", F.col("size").alias("n_shingles"), F.col("c").alias("class"), "component", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies: of those with the least id one with the least text hash; rows without words stay.

    Rows are told apart by id and text, null ids come last, and of rows equal in both one stays. Other columns are those of the row kept.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    ids = keyed.select(F.struct(F.col("id").isNull().alias("none"), "id", "key").alias("doc_id"), "text")
    classes = jaccard_classes(ids, "doc_id", "text", n, percent).where("class IS NOT NULL")
    classes = reliable(classes.groupBy("doc_id").agg(F.first("component_id").alias("least"), F.count("*").alias("rows")))

    def keys(found: DataFrame) -> DataFrame:
        return found.select(F.col("doc_id.id").alias("of_id"), F.col("doc_id.key").alias("of_key"))

    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    rows = keyed.drop("text").join(keys(classes.where("doc_id <> least")), same, "left_anti")
    # rows given more than once: only these are gathered
    again = keys(classes.where("doc_id = least AND rows > 1"))
    once = rows.join(again, same, "left_semi").groupBy("id", "key").agg(F.first("row").alias("row"))
    return rows.join(again, same, "left_anti").select("row.*").unionByName(once.select("row.*"))
