"""Language-model scoring by context-tree weighting over bytes.

A text is read as its lower-cased words, a space after each but the last and a line feed at the end. Each byte is eight
binary decisions; every decision has a tree of the ``DEPTH`` bytes before, whose nodes hold Krichevsky-Trofimov
estimates, and context-tree weighting mixes all depths: a node's weighted probability is half its own estimate's and
half the product of its children's. Counts come from the whole training part. The tree is unfolded where it has data: a context that
was seen ``LEAST`` times is a node, at any size of the input, and all rarer continuations of a node share one child.

Texts are written in slices, each with its distinct keys (context and byte) dealt by hash to buckets. Buckets sum the counts of a key; the keys
that share the ``TOP + 1`` bytes before lie in one part, which holds the whole subtree below those bytes (no more than 256 ** 3 keys, whatever the
input) and weights it bottom-up. What the subtrees pass up is summed by Spark for the depths 0 to ``TOP``, whose tables the alphabet bounds;
they are sent to the tasks. Buckets then answer each slice's distinct keys with the frozen mixture, and slices add up their texts: log10 of
the text's probability, which is its code length.

For comparison, the sum of add-one unigram scores over the tokens: counts of frequent words (``HOT`` at most) are sent to the tasks;
the rest are dealt by word hash to buckets, as packed arrays, which count them and return sums by document.

Defined results: a null or wordless text is only its end; rows with null id are never training rows and are scored; repeated rows are each counted and get
equal scores; without training rows all bits cost one bit; an empty table gives an empty result; only the named columns are read. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from parcelwise.llm.words import SPACED, Words, bytes_of, find_words, mix, slices
from parcelwise.session import reliable, scratch_dir

DEPTH = 5
#: Depths up to this one are tables that are sent to the tasks; the subtrees below are weighted apart.
TOP = 2
#: Sightings that make a context a node.
LEAST = 2
HOT = 1 << 18
#: Bytes of text that a task works on at once; about a hundred times as much memory.
SLICE_BYTES = 2 << 20
#: Bytes of text for each bucket of keys, and keys that a bucket works on at once.
BUCKET_BYTES = 32 << 20
#: Bytes of text whose distinct keys are sent together.
GATHER_BYTES = 16 << 20
KEYS = 100_000
BUCKET_TOKENS = 3_000_000
#: Buckets of words at least, so that a small input is spread as well.
LEAST_BUCKETS = 64
END = 0x0A


def stream(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(key of every byte: the ``DEPTH`` bytes before it and itself, oldest highest; where each text's keys begin)."""
    counts = words.counts
    empty = words.first[:-1][counts == 0]
    start, end = np.insert(words.start, empty, 0), np.insert(words.end, empty, 0)
    first = np.concatenate(([0], np.cumsum(np.maximum(counts, 1))))
    size = end - start + 1  # a word and what follows it
    stops = np.cumsum(size)
    begins = np.concatenate(([0], stops[first[1:] - 1]))
    text = np.repeat(np.arange(len(counts)), np.diff(begins))
    out = np.full(len(text) + DEPTH * len(counts), END, np.uint8)
    at = np.arange(len(text)) + DEPTH * (text + 1)  # each text has its own run-up of line feeds
    source = np.repeat(start - (stops - size), size) + np.arange(len(text))
    source[stops - 1] = 0
    data = words.data if len(words.data) else np.zeros(1, np.uint8)
    body = data[source]
    body[stops - 1] = 0x20
    body[begins[1:] - 1] = END
    out[at] = body
    out = np.concatenate((out, np.zeros(16, np.uint8)))
    eight = np.empty(len(out) - 8, np.uint64)  # the bytes from each one on
    for i in range(8):
        n = len(eight[i::8])
        eight[i::8] = out[i : i + 8 * n].view(">u8")
    return eight[at - DEPTH] >> np.uint64(8 * (7 - DEPTH)), begins


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma for positive x: shifted up by the recurrence, then Stirling's series."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift - np.log(np.where(low, y, 1.0)), shift)
        y = np.where(low, y + 1, y)
    r = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y


@dataclass
class Level:
    """Nodes of one depth and bit number. ``key``: context number * 256 + the byte's bits so far."""

    key: np.ndarray
    one: np.ndarray  # estimate that the bit is 1
    stop: np.ndarray  # weight of this node's own estimate against its children's mixture
    other: np.ndarray  # the estimate of the child that stands for the rare continuations


@dataclass
class ContextTrees:
    """``first``: the depth of ``contexts[0]``, 0 for a whole tree."""

    contexts: list[np.ndarray]  # sorted contexts of each depth
    levels: list[list[Level]]  # [depth][bit]
    first: int = 0
    #: By bit, of the shallowest depth: context * 256 + the bits so far, zeros, ones, log weighted probability.
    up: list[tuple[np.ndarray, ...]] | None = None

    def log10(self, keys: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of the byte of each key after its context."""
        return np.log10(self.chances(keys, below)).sum(axis=1)

    def chances(self, keys: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Probability of each of the eight bits of a key's byte, (keys, 8); not a number if the first context is no node.

        ``below``: the same of the subtrees under the last depth.
        """
        byte = (keys & np.uint64(255)).astype(np.int64)
        ids = []
        alive = np.ones(len(keys), bool)
        for d, known in enumerate(self.contexts):
            context = keys >> np.uint64(8) & np.uint64((1 << 8 * (d + self.first)) - 1)
            at = np.searchsorted(known, context)
            at[at == len(known)] = 0
            alive = alive & (known[at] == context) if len(known) else np.zeros(len(keys), bool)
            ids.append(np.where(alive, at, -1))
        out = np.zeros((len(keys), 8))
        for bit in range(8):
            prefix = byte >> (8 - bit) | 1 << bit
            taken = (byte >> (7 - bit) & 1) == 1
            p, rest = np.zeros(len(keys)), np.ones(len(keys))
            on = np.ones(len(keys), bool)
            last_other = np.full(len(keys), np.nan if self.first else 0.5)
            for d in range(len(self.contexts)):
                level = self.levels[d][bit]
                # a context that is no node: the rare child of the one before
                gone = on & (ids[d] < 0)
                p[gone] += rest[gone] * last_other[gone]
                on = on & ~gone
                want = ids[d] * 256 + prefix
                at = np.searchsorted(level.key, want)
                at[at == len(level.key)] = 0
                met = on & (level.key[at] == want) if len(level.key) else np.zeros(len(keys), bool)
                new = on & ~met  # no such decision was seen here or deeper: all estimates are one half
                p[new] += rest[new] * 0.5
                on = met
                at = at[met]
                p[met] += rest[met] * level.stop[at] * np.where(taken[met], level.one[at], 1 - level.one[at])
                rest[met] *= 1 - level.stop[at]
                last_other[met] = np.where(taken[met], level.other[at], 1 - level.other[at])
            if below is not None:
                p[on] += rest[on] * np.where(np.isnan(below[on, bit]), last_other[on], below[on, bit])
            out[:, bit] = p
        return out


def build(entries: list[tuple[np.ndarray, np.ndarray]], first: int = 0, below: tuple[np.ndarray, ...] | None = None) -> ContextTrees:
    """The weighted trees from (key, count) of each depth from ``first`` on, keys sorted, a key being a context and the byte after it.

    ``below``: as ``ContextTrees.up``, summed over the subtrees under each context of the last depth, bits together.
    """
    contexts, numbers = [], []
    for key, _ in entries:
        known, number = np.unique(key >> np.uint64(8), return_inverse=True)
        contexts.append(known)
        numbers.append(number.astype(np.int64))
    levels: list[list[Level]] = [[] for _ in entries]
    up = []
    for bit in range(8):
        deeper: tuple | None = None  # key, zeros, ones, log weighted probability of the depth below
        for d in range(len(entries) - 1, -1, -1):
            key, n = entries[d]
            byte = (key & np.uint64(255)).astype(np.int64)
            node = numbers[d] * 256 + (byte >> (8 - bit) | 1 << bit)
            turn = np.flatnonzero(np.concatenate((np.ones(min(1, len(node)), bool), node[1:] != node[:-1])))
            is_one = (byte >> (7 - bit) & 1) == 1
            sums = [np.add.reduceat(np.where(side, n, 0), turn).astype(np.float64) if len(turn) else np.zeros(0) for side in (~is_one, is_one)]
            node = node[turn]
            own = _log_kt(*sums)
            if deeper is None and below is not None:
                mine = below[0] & np.uint64(255)
                mine = (mine >= 1 << bit) & (mine < 2 << bit)
                parent = np.searchsorted(contexts[d], below[0][mine] >> np.uint64(8)) * 256 + (below[0][mine] & np.uint64(255)).astype(np.int64)
                deeper = (parent, *[x[mine] for x in below[1:]])
            elif deeper is not None:
                under, zeros, ones, weight = deeper
                parent = np.searchsorted(contexts[d], contexts[d + 1] & np.uint64((1 << 8 * (d + first)) - 1))[under // 256] * 256 + under % 256
                deeper = parent, zeros, ones, weight
            if deeper is None:
                weighted, stop, other = own, np.ones(len(node)), np.full(len(node), 0.5)
            else:
                parent, zeros, ones, weight = deeper
                at = np.searchsorted(node, parent)
                left = [s - np.bincount(at, x, len(node)) for s, x in zip(sums, (zeros, ones))]
                left = [np.maximum(x, 0) for x in left]
                split = np.bincount(at, weight, len(node)) + _log_kt(*left)
                both = np.logaddexp(own, split)
                weighted, stop, other = both - np.log(2), np.exp(own - both), (left[1] + 0.5) / (left[0] + left[1] + 1)
            levels[d].append(Level(node, (sums[1] + 0.5) / (sums[0] + sums[1] + 1), stop, other))
            deeper = node, sums[0], sums[1], weighted
        node = deeper[0]
        up.append((contexts[0][node // 256] << np.uint64(8) | (node % 256).astype(np.uint64), *deeper[1:]))
    return ContextTrees(contexts, levels, first, up)


def _sum(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of ``n`` over each."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    turn = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[turn], np.add.reduceat(n[order], turn)


def _distinct(key: np.ndarray) -> np.ndarray:
    """Distinct keys in order."""
    key = np.sort(key)
    return key[np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))]


def _found(known: np.ndarray, value: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The value of each key, all of them among the sorted known ones.

    Keys have ``DEPTH + 1`` bytes, so the places of 2**16 of them fit beside them: sorted together, they are looked up in order, which
    takes a third of the time of looking them up as they come.
    """
    out = np.empty(len(key), value.dtype)
    for at in range(0, len(key), 1 << 16):
        some = key[at : at + (1 << 16)] << np.uint64(16)
        some = np.sort(some | np.arange(len(some), dtype=np.uint64))
        out[at + (some & np.uint64(0xFFFF)).astype(np.int64)] = value[np.searchsorted(known, some >> np.uint64(16))]
    return out


def _depth(key: np.ndarray, n: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, count) of the contexts of depth ``d`` that are nodes."""
    key, n = _sum(key & np.uint64((1 << 8 * (d + 1)) - 1), n)
    if not len(key) or not d:
        return key, n
    turn = np.flatnonzero(np.concatenate(([True], key[1:] >> np.uint64(8) != key[:-1] >> np.uint64(8))))
    kept = np.repeat(np.add.reduceat(n, turn) >= LEAST, np.diff(np.append(turn, len(key))))
    return key[kept], n[kept]


def _count(rows: DataFrame) -> DataFrame:
    """(kind, key, n) over training rows: 1 words by hash, 2 the number of texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                words = find_words(part.column(0), SPACED, lower=True)
                found = [np.unique(words.hashes(), return_counts=True), (np.zeros(1, np.uint64), np.array([part.num_rows]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(1, 3, dtype=np.int32), [len(k) for k, _ in found])), pa.array(np.concatenate([k for k, _ in found]).view(np.int64)),
                     pa.array(np.concatenate([n for _, n in found]).astype(np.int64))],
                    names=["kind", "key", "n"],
                )

    return rows.select("text").mapInArrow(scan, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _packed(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of all rows of a binary column, one after the other."""
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(x.as_py(), dtype) for x in column]])


def _pack(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of whole numbers, byte by byte together, compressed."""
    planes = x.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(x).to_bytes(4, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def _unpack(packed: bytes, width: int) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.Codec("zstd").decompress(packed[4:], n * width, asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.uint64)


def _unpacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[_unpack(x.as_py(), width) for x in column]])


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(key) >> np.uint64(32)) % np.uint64(buckets)


def _pieces(bucket: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """The buckets that have any of the sorted numbers, with where these are."""
    turn = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(b, slice(turn[b], turn[b + 1])) for b in np.flatnonzero(np.diff(turn))]


def _write_slices(rows: DataFrame, buckets: int) -> DataFrame:
    """Slices of the texts (``bucket`` -1) and their distinct keys by bucket, with the number of sightings in training rows."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for whole in slices(batch, 3, GATHER_BYTES):
                found = []
                for part in slices(whole, 3, SLICE_BYTES):
                    key, begins = stream(find_words(part.column(3), SPACED, lower=True))
                    train = np.repeat(part.column(2).to_numpy(zero_copy_only=False).astype(bool), np.diff(begins))
                    key = np.sort(key << np.uint64(1) | train.astype(np.uint64))
                    trained, key = (key & np.uint64(1)).astype(np.int64), key >> np.uint64(1)
                    turn = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                    found.append((key[turn], np.add.reduceat(trained, turn)))
                key, n = _sum(*map(np.concatenate, zip(*found)))
                bucket = _bucket(key, buckets)
                order = np.argsort(bucket, kind="stable")
                key, n = key[order], n[order]
                pieces = _pieces(bucket[order], buckets)
                data, offsets = bytes_of(whole.column(3))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (whole.column(0), whole.column(1), pa.array(np.diff(offsets)))]
                text = pa.Codec("zstd").compress(data.tobytes(), asbytes=True)
                names = ["bucket", "slice", "keys", "counts", "doc_ids", "text_keys", "sizes", "text"]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[x.type for x in lists], pa.binary()]
                nones = [None] * len(pieces)
                for columns in (
                    [[-1], [number], [None], [None], *lists, [text]],
                    [[b for b, _ in pieces], [number] * len(pieces), [_pack(key[p], DEPTH + 1) for _, p in pieces], [_pack(n[p], 4) for _, p in pieces], *[nones] * 4],
                ):
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) if isinstance(x, list) else x for x, k in zip(columns, kinds)], names=names)
                number += 1

    path = scratch_dir(rows.sparkSession, "slices")
    rows.mapInArrow(deal, f"bucket int, slice bigint, keys binary, counts binary, doc_ids array<{id_type}>, text_keys array<bigint>, sizes array<bigint>, text binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _subtrees(dealt: DataFrame, buckets: int) -> DataFrame:
    """(kind, key, zeros, ones, weight, keys, chances) of the depths below ``TOP``.

    Kind 0: by bucket (in ``key``), keys with the chances of their bits in the subtree; 1: a key of depth ``TOP`` and its count (in ``ones``); 2: what a
    subtree passes up to a decision of depth ``TOP``.
    """

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        mine, n = _sum(_unpacked(table["keys"], DEPTH + 1), _unpacked(table["counts"], 4).astype(np.int64))
        part = _bucket(mine >> np.uint64(8) & np.uint64((1 << 8 * (TOP + 1)) - 1), buckets)
        order = np.argsort(part, kind="stable")
        mine, n = mine[order], n[order]
        pieces = _pieces(part[order], buckets)
        return pa.table({"part": pa.array([b for b, _ in pieces], pa.int32()), "keys": pa.array([mine[p].tobytes() for _, p in pieces], pa.binary()), "counts": pa.array([n[p].tobytes() for _, p in pieces], pa.binary())})

    def weigh(table: pa.Table) -> pa.Table:
        mine, n = _packed(table["keys"], np.uint64), _packed(table["counts"], np.int64)
        shared = mine >> np.uint64(8) & np.uint64((1 << 8 * (TOP + 1)) - 1)
        order = np.argsort(shared, kind="stable")
        mine, n, shared = mine[order], n[order], shared[order]
        at, out = 0, []
        while at < len(mine):
            last = shared[min(at + KEYS, len(mine)) - 1]
            to = int(np.searchsorted(shared, last, side="right"))
            out.extend(subtree(mine[at:to], n[at:to]))
            at = to
        return pa.Table.from_batches(out)

    def subtree(mine: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        seen = n > 0
        trees = build([_depth(mine[seen], n[seen], d) for d in range(TOP + 1, DEPTH + 1)], TOP + 1)
        counts = _sum(mine[seen] & np.uint64((1 << 8 * (TOP + 1)) - 1), n[seen])
        yield rows(1, counts[0], ones=counts[1])
        above = np.concatenate([x[0] for x in trees.up]) & np.uint64((1 << 8 * (TOP + 1)) - 1)
        yield rows(2, above, *[np.concatenate([x[i] for x in trees.up]) for i in (1, 2, 3)])
        bucket = _bucket(mine, buckets)
        order = np.argsort(bucket, kind="stable")
        mine = mine[order]
        chances = np.concatenate([np.zeros((0, 8)), *[trees.chances(mine[i : i + KEYS]) for i in range(0, len(mine), KEYS)]])
        pieces = _pieces(bucket[order], buckets)
        yield rows(0, np.array([b for b, _ in pieces]), packed=([mine[p].tobytes() for _, p in pieces], [chances[p].tobytes() for _, p in pieces]))

    def rows(kind: int, key, zeros=None, ones=None, weight=None, packed=None) -> pa.RecordBatch:
        numbers = [np.zeros(len(key)) if x is None else np.asarray(x, np.float64) for x in (zeros, ones, weight)]
        binaries = [pa.array(x, pa.binary()) for x in packed or ([None] * len(key),) * 2]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.int64)), *map(pa.array, numbers), *binaries], names=["kind", "key", "zeros", "ones", "weight", "keys", "chances"])

    merged = dealt.groupBy("bucket").applyInArrow(merge, "part int, keys binary, counts binary")
    return merged.groupBy("part").applyInArrow(weigh, "kind int, key bigint, zeros double, ones double, weight double, keys binary, chances binary")


def _top(found: DataFrame) -> ContextTrees:
    """The depths down to ``TOP``."""
    sums = found.where("kind > 0").groupBy("kind", "key").agg(*[F.sum(x).alias(x) for x in ("zeros", "ones", "weight")]).toArrow()
    kind, key = sums["kind"].to_numpy(), sums["key"].to_numpy().view(np.uint64)
    n = sums["ones"].to_numpy()
    counts = kind == 1
    below = [x[~counts] for x in (key, sums["zeros"].to_numpy(), n, sums["weight"].to_numpy())]
    return build([_depth(key[counts], n[counts].astype(np.int64), d) for d in range(TOP + 1)], 0, tuple(below))


def _answers(dealt: DataFrame, found: DataFrame, top) -> DataFrame:
    """(slice, bucket, scores): log10 probability of each of a slice's distinct keys, in the order in which they were sent."""

    def answer(key: tuple, asked: pa.Table, table: pa.Table) -> pa.Table:
        mine, chances = _packed(table["keys"], np.uint64), _packed(table["chances"], np.float64).reshape(-1, 8)
        value = np.concatenate([np.zeros(0), *[top.value.log10(mine[i : i + KEYS], chances[i : i + KEYS]) for i in range(0, len(mine), KEYS)]])
        order = np.argsort(mine)
        mine, value = mine[order], value[order]
        return pa.table({
            "slice": asked["slice"], "bucket": asked["bucket"],
            "scores": pa.array([value[np.searchsorted(mine, _unpack(x.as_py(), DEPTH + 1))].tobytes() for x in asked["keys"]], pa.binary()),
        })

    keys = found.where("kind = 0").select(F.col("key").cast("int").alias("bucket"), "keys", "chances")
    return dealt.select("bucket", "slice", "keys").groupBy("bucket").cogroup(keys.groupBy("bucket")).applyInArrow(answer, "slice bigint, bucket int, scores binary")


def _deal_rare(rows: DataFrame, hot, buckets: int) -> DataFrame:
    """The words that are not hot, dealt by hash to buckets as packed arrays; with them only the documents that hold them."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, SLICE_BYTES):
                words = find_words(part.column(3), SPACED, lower=True)
                h, row = words.hashes(), words.rows()
                at = np.searchsorted(hot.value[0], h)
                at[at == len(hot.value[0])] = 0
                rare = hot.value[0][at] != h if len(hot.value[0]) else np.ones(len(h), bool)
                h, row = h[rare], row[rare]
                bucket = (h >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                h, row, bucket = h[order], row[order].astype(np.int32), bucket[order]
                ids, keys = part.column(0).to_pylist(), part.column(1)
                train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                turn = np.searchsorted(bucket, np.arange(buckets + 1))
                used = [b for b in range(buckets) if turn[b + 1] > turn[b]]
                if not used:
                    continue
                pieces = [slice(turn[b], turn[b + 1]) for b in used]
                docs = [np.unique(row[p]) for p in pieces]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([h[p].tobytes() for p in pieces], pa.binary()),
                     pa.array([np.searchsorted(d, row[p]).astype(np.int32).tobytes() for d, p in zip(docs, pieces)], pa.binary()),
                     pa.array([[ids[i] for i in d] for d in docs], pa.list_(part.schema.field(0).type)),
                     pa.array([keys.take(pa.array(d)).to_numpy(zero_copy_only=False) for d in docs], pa.list_(pa.int64())),
                     pa.array([train[d] for d in docs], pa.list_(pa.bool_()))],
                    names=["bucket", "words", "places", "doc_ids", "text_keys", "train"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(deal, f"bucket int, words binary, places binary, doc_ids array<{id_type}>, text_keys array<bigint>, train array<boolean>")


def _rare_sums(rows: DataFrame, hot, buckets: int) -> DataFrame:
    """(doc_id, text_key, log_sum, known, rows): log10(c + 1) summed over the words that are not hot, by document."""

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["words"]])
        sizes = np.array([len(x) for x in table["doc_ids"]])
        lengths = np.array([len(x.as_py()) // 4 for x in table["places"]])
        doc = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in table["places"]]) + np.repeat(np.cumsum(sizes) - sizes, lengths)
        flat = [pa.concat_arrays([c.flatten() for c in table[x].chunks]) for x in ("doc_ids", "text_keys", "train")]
        train = flat[2].to_numpy(zero_copy_only=False).astype(bool)
        _, word = np.unique(h, return_inverse=True)
        c = np.bincount(word, train[doc], word.max(initial=-1) + 1)
        n = int(sizes.sum())
        return pa.table({
            "doc_id": flat[0], "text_key": flat[1], "log_sum": np.bincount(doc, np.log10(c + 1)[word], n).astype(np.float64),
            "known": np.bincount(doc, c[word] > 0, n).astype(np.int64), "rows": np.zeros(n, np.int64),
        })

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = _deal_rare(rows, hot, buckets).groupBy("bucket").applyInArrow(sums, f"doc_id {id_type}, text_key bigint, log_sum double, known bigint, rows bigint")
    each = rows.select("doc_id", "text_key", F.lit(0.0).alias("log_sum"), F.lit(0).cast("long").alias("known"), F.lit(1).cast("long").alias("rows"))
    return found.unionByName(each).groupBy("doc_id", "text_key").agg(F.sum("log_sum").alias("log_sum"), F.sum("known").alias("known"), F.sum("rows").alias("rows"))


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, code_bytes) of every text; ``train``: a condition on ``doc_id`` for rows to learn from.

    ``code_bytes``: the code length per byte of the text's stream, in bits.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", "text_key", F.coalesce(train, F.lit(False)).alias("train"), "text")
    spark = docs.sparkSession
    counted = reliable(_count(rows.where("train")))
    facts = {r["kind"]: r for r in counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("different")).collect()}
    texts = facts[2]["n"] if 2 in facts else 0
    n_train = (facts[1]["n"] if 1 in facts else 0) + texts
    vocabulary = (facts[1]["different"] if 1 in facts else 0) + (1 if texts else 0)
    frequent = counted.where((F.col("kind") == 1) & (F.col("n") >= max(1, n_train / HOT))).select("key", "n").toArrow()
    order = np.argsort(frequent["key"].to_numpy().view(np.uint64))
    hot = spark.sparkContext.broadcast((frequent["key"].to_numpy().view(np.uint64)[order], np.log10(frequent["n"].to_numpy()[order] + 1.0)))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = text_bytes // BUCKET_BYTES + 1
    written = _write_slices(rows, buckets)
    dealt = written.where("bucket >= 0").select("bucket", "slice", "keys", "counts")
    found = reliable(_subtrees(dealt, buckets))
    top = spark.sparkContext.broadcast(_top(found))

    def judge(_: tuple, part: pa.Table, answers: pa.Table) -> pa.Table:
        doc_ids, text_keys, sizes = (pa.concat_arrays([c.flatten() for c in part[x].chunks]) for x in ("doc_ids", "text_keys", "sizes"))
        offsets = np.concatenate(([0], np.cumsum(sizes.to_numpy())))
        data = pa.Codec("zstd").decompress(part["text"][0].as_py(), int(offsets[-1]))
        whole = pa.record_batch([pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), data)], names=["text"])
        # streams are made twice: kept, they would be eight times the slice
        counts, hot_sum, n_hot, distinct, scores, sizes_in_keys = [], [], [], [], [], []
        for some in slices(whole, 0, SLICE_BYTES):
            words = find_words(some.column(0), SPACED, lower=True)
            distinct.append(_distinct(stream(words)[0]))
            h, row = words.hashes(), words.rows()
            table, logs = hot.value
            at = np.searchsorted(table, h)
            at[at == len(table)] = 0
            is_hot = table[at] == h if len(table) else np.zeros(len(h), bool)
            hot_sum.append(np.bincount(row[is_hot], logs[at[is_hot]], some.num_rows).astype(np.float64))
            n_hot.append(np.bincount(row[is_hot], minlength=some.num_rows).astype(np.int64))
            counts.append(words.counts.astype(np.int64) + 1)
            del words, h, row, at
        distinct = _distinct(np.concatenate(distinct))
        value = np.zeros(len(distinct))
        value[np.argsort(_bucket(distinct, buckets), kind="stable")] = _packed(answers.sort_by("bucket")["scores"], np.float64)
        for some in slices(whole, 0, SLICE_BYTES):
            key, begins = stream(find_words(some.column(0), SPACED, lower=True))
            scores.append(np.add.reduceat(_found(distinct, value, key), begins[:-1]))
            sizes_in_keys.append(np.diff(begins))
            del key
        score, size = np.concatenate(scores), np.concatenate(sizes_in_keys)
        return pa.table(
            [doc_ids, text_keys, pa.array(np.concatenate(counts)), pa.array(np.concatenate(hot_sum)), pa.array(np.concatenate(n_hot)), pa.array(score), pa.array(-score * np.log2(10) / size)],
            names=["doc_id", "text_key", "n_tokens", "hot_sum", "n_hot", "score", "code_bytes"],
        )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    packed = written.where("bucket < 0").select("slice", "doc_ids", "text_keys", "sizes", "text")
    scored = packed.groupBy("slice").cogroup(_answers(dealt, found, top).groupBy("slice")).applyInArrow(
        judge, f"doc_id {id_type}, text_key bigint, n_tokens bigint, hot_sum double, n_hot bigint, score double, code_bytes double"
    )
    rest = _rare_sums(rows, hot, max(LEAST_BUCKETS, -(-n_train // BUCKET_TOKENS))).select(F.col("doc_id").alias("rare_id"), F.col("text_key").alias("rare_key"), "log_sum", "known", "rows")
    joined = scored.join(rest, scored["doc_id"].eqNullSafe(rest["rare_id"]) & (scored["text_key"] == rest["rare_key"]), "left")
    each = float(np.log10(n_train + vocabulary + 1))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_hot") + (F.col("known") / F.col("rows")).cast("long") + (1 if texts else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.col("log_sum") / F.col("rows") + float(np.log10(texts + 1)) - F.col("n_tokens") * each).alias("base_score"), "score", "code_bytes",
    )
