"""Packing along a space-filling curve: like documents end up in one training sequence.

A document's vector counts its words in hashed places; a fixed random projection takes it to ``DIMENSIONS`` coordinates,
which a Hilbert curve turns into one key. The curve is cut into ranges of near equal bytes, found from the bytes of its
2**16 equal parts; a part that is more than a range (copies have one key, very long texts near ones) is dealt to several by a
hash of the id. Each range is sorted by (key, id, checksum). Each task then encodes its documents in that order, lays
their ids end to end and cuts every ``length`` ids. What is left at a task's end is cut at powers of two, so nothing is
padded there either. The texts are shuffled once and encoded once, after the shuffle; the key pass runs twice, first
for the bytes of the parts.

Encoding goes word by word: the vocabulary never joins across ASCII white space, so each distinct word of a slice is encoded
once (with a bounded cache between slices and tasks) and the ids are gathered with numpy. New words of Latin letters are
encoded some hundred at a time as one text, which is cut again where its words end.

Defined results: a null text is an empty one and gives the single end id; repeated rows are packed each; ids may be null
or of any type; an empty table gives no pieces; only the named columns are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from parcelwise.llm.words import LOWER, SPACED, Words, bytes_of, find_words, mix, slices

DIMENSIONS, BITS = 4, 15
KEY_BITS, PART_BITS = DIMENSIONS * BITS, 16
#: Bytes of text in one range at most (but for one document).
RANGE_BYTES = 128 << 20
#: Pieces that a worker keeps, about 70 bytes each.
CACHED_WORDS = 1 << 19
#: Bytes of text that a task encodes at once, about eighty times as much memory; new pieces that the vocabulary encodes at once, a kilobyte each.
SLICE_BYTES = 2 << 20
NEW_PIECES = 8192
#: Words of Latin letters that are given to the vocabulary as one text.
JOINED_PIECES = 256
#: How far a mean coordinate of 1 lies out before it is squeezed into (0, 1).
SCALE = 8.0


def coordinates(words: Words) -> np.ndarray:
    """Texts x DIMENSIONS in 0 .. 2**BITS - 1: the mean over a text's words of a random vector fixed by the word."""
    h = words.hashes()
    out = np.zeros((len(words.first) - 1, DIMENSIONS))
    has = words.counts > 0
    for j in range(DIMENSIONS):
        value = (mix(h + np.uint64(j)) >> np.uint64(40)).astype(np.float64) / (1 << 23) - 1
        if has.any():
            out[has, j] = np.add.reduceat(value, words.first[:-1][has]) / words.counts[has]
    squeezed = 0.5 + 0.5 * np.tanh(SCALE * out)
    return np.minimum((squeezed * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point on the Hilbert curve of its dimension (axes to transposed index, then interleaved)."""
    x = [points[:, j].astype(np.int64) for j in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x = [v ^ t for v in x]
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = key << 1 | (v >> b & 1)
    return key


#: ASCII letters and everything outside ASCII; ASCII marks.
_LETTERS = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_MARKS = np.array([0x21 <= b <= 0x7E and not chr(b).isalnum() for b in range(256)])


def word_pieces(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, is lower-cased, where each text's pieces begin): words, cut where letters at their start meet an ASCII mark.

    A vocabulary that sets letters and other signs apart encodes both parts as it would the word: the last letter
    is one for sure (ASCII or Latin-1), nothing combines with an ASCII mark, and no contraction or special token ends in front
    of one. It leaves far fewer distinct pieces than words.
    """
    data, start, end = words.data, words.start, words.end
    other = np.append(np.flatnonzero(~_LETTERS[data]), len(data))
    cut = other[np.searchsorted(other, start)]
    inside = (cut > start) & (cut < end)
    at = np.where(inside, cut, start + 1)
    last, before = data[at - 1], data[np.maximum(at - 2, 0)]
    letter = (last < 0x80) | ((before == 0xC3) & (last != 0x97) & (last != 0xB7) & (at - 2 >= start))
    split = inside & letter & _MARKS[data[np.minimum(at, len(data) - 1)]] if len(data) else inside
    whole = ~inside & (cut >= end)  # letters only
    n = 1 + split
    stops = np.cumsum(n)
    head = stops - n
    piece_start, piece_end, low = np.empty(stops[-1] if len(stops) else 0, np.int64), np.empty(stops[-1] if len(stops) else 0, np.int64), np.zeros(stops[-1] if len(stops) else 0, bool)
    piece_start[head], piece_end[head], low[head] = start, np.where(split, cut, end), split | whole
    tail = head[split] + 1
    piece_start[tail], piece_end[tail] = cut[split], end[split]
    return piece_start, piece_end, low, np.concatenate(([0], stops))[words.first]


def distinct_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each piece's string, a place of each string, its hash); found by hash, then compared byte by byte."""
    whole = np.array([0, len(start)])
    hashes = Words(data, start, end, whole, np.array([0, len(data)])).hashes()
    code, _ = pd.factorize(hashes)
    at = np.zeros(code.max(initial=-1) + 1, np.int64)
    at[code[::-1]] = np.arange(len(code))[::-1]
    length = end - start
    same = (length == length[at][code]).all()
    if same and len(start):
        twin = np.repeat(start[at][code] - start, length) + np.arange(len(data))
        same = (data[twin] == data).all()
    if not same:  # two strings with one hash
        raw = data.tobytes()
        code, strings = pd.factorize(np.array([raw[a:b] for a, b in zip(start, end)], object))
        at = np.zeros(len(strings), np.int64)
        at[code[::-1]] = np.arange(len(code))[::-1]
    return code.astype(np.int64), at, hashes[at]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + size[i] - 1 of all i, end to end."""
    stops = np.cumsum(size)
    return np.repeat(start - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)


@dataclass
class Known:
    """Pieces by number: piece i is ``data[bounds[i]:bounds[i + 1]]``, has ``ids[stops[i]:stops[i + 1]]`` and was last met in slice ``met[i]``."""

    data: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    bounds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    stops: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    met: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # in order
    number: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of the piece with this hash

    def __len__(self) -> int:
        return len(self.met)

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 if it is not known; found by hash, then compared byte by byte."""
        if not len(self):
            return np.full(len(start), -1)
        order, at = np.argsort(hashes), np.empty(len(hashes), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self) - 1)
        number, size = self.number[at], end - start
        same = (self.hashes[at] == hashes) & (np.diff(self.bounds)[number] == size)
        maybe = np.flatnonzero(same)
        size = size[maybe]
        differ = data[_runs(start[maybe], size)] != self.data[_runs(self.bounds[number[maybe]], size)]
        same[np.repeat(maybe, size)[differ]] = False
        return np.where(same, number, -1)

    def add(self, data: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, met: np.ndarray | int) -> None:
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.number = np.insert(self.number, at, len(self) + order)
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.met = np.append(self.met, np.broadcast_to(met, len(hashes)))
        self.data, self.ids = np.append(self.data, data), np.append(self.ids, ids)
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(lengths))
        self.stops = np.append(self.stops, self.stops[-1] + np.cumsum(sizes))

    def latest(self, most: int) -> Known:
        """The ``most`` pieces that were met last."""
        keep = np.sort(np.argsort(-self.met, kind="stable")[:most])
        hashes = np.empty(len(self), np.uint64)
        hashes[self.number] = self.hashes
        lengths, sizes, out = np.diff(self.bounds)[keep], np.diff(self.stops)[keep], Known()
        out.add(self.data[_runs(self.bounds[keep], lengths)], lengths, hashes[keep], self.ids[_runs(self.stops[keep], sizes)], sizes, self.met[keep])
        return out


def _latin(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each piece (from its start to the next one's) holds letters of ASCII and Latin-1 alone: one run of letters by any Unicode version, in any case."""
    if not len(start):
        return np.zeros(0, bool)
    second = np.concatenate(([False], data[:-1] == 0xC3))
    good = (data < 0x80) & _LETTERS[data] | (data == 0xC3) | second & (data != 0x97) & (data != 0xB7)
    return np.logical_and.reduceat(good, start)


#: Signs, cases and scripts on which a vocabulary shows whether its words can be cut as ``word_pieces`` does.
PROBE = "Hello, WORLD's don't re-use x3 (a.b) \u00c9t\u00e9! stra\u00dfe: \u4e2d\u6587 \u0440\u0443\u0441\u0441\u043a\u0438\u0439\u2026 caf\u00e9-bar #1 a_b I'LL  tab\tend\n"


class WordEncoder:
    """Ids of texts by way of their distinct pieces. One for each vocabulary and Python worker, so tasks share what is known.

    When more is known than should be kept, the half that was met last stays, so frequent pieces are encoded once. A vocabulary
    that encodes the probe otherwise than by its pieces (a cased one, or one that keeps white space) is given whole texts.
    """

    made: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.slices = Known(), 0
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab() if suffix else {}
        #: By id, whether a word ends with it; empty if the vocabulary does not tell.
        self.ends_word = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        probe = pa.array([PROBE])
        self.by_pieces = True
        self.by_pieces = self.encode(probe, 0)[0].tolist() == self._whole(probe, 0)[0].tolist()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def _tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts end to end, how many each has)."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), NEW_PIECES):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + NEW_PIECES], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _piece_tokens(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_tokens``, of pieces end to end: words of Latin letters are joined by spaces and cut again after each id that ends a word."""
        stops = np.cumsum(length)
        latin = _latin(data, stops - length) & (len(self.ends_word) > 0)
        spaced = np.insert(data, stops, 0x20)
        start = stops - length + np.arange(len(length))

        def tokens(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            raw = spaced.tobytes()
            return self._tokens([raw[a:b].decode() for a, b in zip(start[of].tolist(), (start + length)[of].tolist())])

        joined = spaced[_runs(start[latin], length[latin] + 1)].tobytes()
        cuts = np.concatenate(([0], np.cumsum(length[latin] + 1)))[[*range(0, latin.sum(), JOINED_PIECES), -1]].tolist()
        ids, _ = self._tokens([joined[a:b].decode() for a, b in zip(cuts, cuts[1:])])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != latin.sum():
            return tokens(np.full(len(length), True))
        other_ids, other_sizes = tokens(~latin)
        sizes = np.empty(len(length), np.int64)
        sizes[latin], sizes[~latin] = np.diff(ends, prepend=0), other_sizes
        out, of_latin = np.empty(len(ids) + len(other_ids), np.uint32), np.repeat(latin, sizes)
        out[of_latin], out[~of_latin] = ids, other_ids
        return out, sizes

    def _whole(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self._tokens(texts.to_pylist())
        stops = np.cumsum(sizes)
        return np.insert(ids, stops, np.uint32(end_id)), np.concatenate(([0], stops + np.arange(1, len(sizes) + 1)))

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each of these distinct pieces among the known; new ones are encoded."""
        if len(self.known) > CACHED_WORDS:
            self.known = self.known.latest(CACHED_WORDS // 2)
        self.slices += 1
        known = self.known
        number = known.find(data, start, end, hashes)
        new = np.flatnonzero(number < 0)
        number[new] = len(known) + np.arange(len(new))
        length = end[new] - start[new]
        theirs = data[_runs(start[new], length)]
        ids, sizes = self._piece_tokens(theirs, length)
        known.add(theirs, length, hashes[new], ids, sizes, self.slices)
        known.met[number] = self.slices
        return number

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, each with ``end_id`` at its end; where each text begins)."""
        if not self.by_pieces:
            return self._whole(texts, end_id)
        words = find_words(texts, SPACED)
        start, end, low, first = word_pieces(words)
        length = end - start
        stops = np.cumsum(length)
        data = LOWER[words.data]
        cased = _runs(start[~low], length[~low])
        data[cased] = words.data[cased]
        data = data[SPACED[data]]  # pieces cover the words without a gap
        code, at, hashes = distinct_pieces(data, stops - length, stops)
        number = self._numbers(data, (stops - length)[at], stops[at], hashes)
        known = self.known
        place, size = np.append(known.stops[number], len(known.ids)), np.append(known.stops[number + 1] - known.stops[number], 1)
        table = np.append(known.ids, np.uint32(end_id))
        # each text's pieces, then its end
        code = np.insert(code, first[1:], len(number))
        sizes = size[code]
        stops = np.cumsum(sizes)
        ids = table[_runs(place[code], sizes)]
        ends = stops[first[1:] + np.arange(len(first) - 1)] if len(stops) else np.zeros(0, np.int64)
        return ids, np.concatenate(([0], ends))


def _ranges(parts: DataFrame) -> tuple[DataFrame, int]:
    """(part, first, ways) and the number of ranges: a part goes to the ``ways`` ranges from ``first`` on. At most 2**PART_BITS rows."""
    spark = parts.sparkSession
    found = parts.toArrow().to_pandas().sort_values("part")
    size = found["bytes"].to_numpy(np.int64)
    total = int(size.sum())
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    before = np.cumsum(size) - size
    first = before * ranges // max(total, 1)
    last = np.maximum(first, (before + size) * ranges // max(total, 1) - 1)
    table = pd.DataFrame({"part": found["part"].to_numpy(np.int64), "first": first.astype(np.int32), "ways": (last - first + 1).astype(np.int32)})
    return spark.createDataFrame(pa.Table.from_pandas(table, preserve_index=False)), ranges


def _cuts(left: int, length: int) -> list[int]:
    """Sequence lengths for what is left: full ones, then powers of two."""
    out = [length] * (left // length)
    rest = left % length
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece.

    ``length`` of a sequence is a power of two. sequence_id holds the task's number in its high bits: unique, not gapless.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                key = hilbert_key(coordinates(find_words(part.column(1), SPACED, lower=True)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(key)], names=["doc_id", "text", "check", "key"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                key = hilbert_key(coordinates(find_words(part.column(0), SPACED, lower=True)))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.diff(bytes_of(part.column(0))[1]) + 1)], names=["key", "bytes"])

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer_path)
        base = TaskContext.get().partitionId() << 32
        sequence, filled = 0, 0
        held: list[tuple] = []  # pieces of the sequence that is being filled

        def piece(doc, start, size, total, ids, at) -> tuple:
            return doc, start, size, zlib.crc32(np.ascontiguousarray(ids[start : start + size], "<u4").tobytes()), total, base + sequence, at, ids[start : start + size]

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                done: list[tuple] = []
                ids, first = encoder.encode(part.column(1), end_id)
                for doc, a, b in zip(part.column(0).to_pylist(), first[:-1], first[1:]):
                    mine, start, total = ids[a:b], 0, int(b - a)
                    while start < total:
                        size = min(total - start, length - filled)
                        held.append(piece(doc, start, size, total, mine, filled))
                        start, filled = start + size, filled + size
                        if filled == length:
                            done += held
                            held, sequence, filled = [], sequence + 1, 0
                if done:
                    yield _batch(done, doc_type, with_ids)
        rest, sizes = held, _cuts(filled, length)
        out, at = [], 0
        for doc, start, size, _, total, _, _, ids in rest:
            used = 0
            while used < size:
                take = min(size - used, sizes[0] - at)
                part_ids = ids[used : used + take]
                out.append((doc, start + used, take, zlib.crc32(np.ascontiguousarray(part_ids, "<u4").tobytes()), total, base + sequence, at, part_ids))
                used, at = used + take, at + take
                if at == sizes[0]:
                    sizes, sequence, at = sizes[1:], sequence + 1, 0
        if out:
            yield _batch(out, doc_type, with_ids)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("check", F.crc32(F.col("text").cast("binary")))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    doc_type = rows.limit(0).select("doc_id").toArrow().schema.field(0).type
    keyed = rows.mapInArrow(keys, f"doc_id {id_type}, text string, check bigint, key bigint").withColumn("part", F.shiftright("key", KEY_BITS - PART_BITS))
    sizes = rows.select("text").mapInArrow(measure, "key bigint, bytes bigint")
    table, ranges = _ranges(sizes.groupBy(F.shiftright("key", KEY_BITS - PART_BITS).alias("part")).agg(F.sum("bytes").alias("bytes")))
    placed = keyed.join(F.broadcast(table), "part").withColumn("range", F.expr("first + CAST(pmod(xxhash64(doc_id, check), ways) AS int)"))
    ordered = placed.repartitionById(ranges, "range").sortWithinPartitions("key", "doc_id", "check").select("doc_id", "text")
    fields = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ordered.mapInArrow(lay_out, fields + ", ids array<int>" * with_ids)


def _batch(pieces: list[tuple], doc_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*pieces))
    arrays = [pa.array(columns[0], doc_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        offsets = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(columns[7]).astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)
