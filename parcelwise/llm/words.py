"""Words of many texts at once: byte classes, word bounds and 64-bit word hashes as numpy arrays.

Everything here works on the UTF-8 bytes of one Arrow string column inside a task. A class of word bytes is a
table of 256 booleans: both word rules in use split at ASCII bytes only, so bytes of 128 and above always belong
to a word and no character is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
U64 = np.uint64


def _table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words are runs of bytes other than the six ASCII spaces.
SPACED = _table(lambda b: b not in SPACES)
#: Words are runs of ASCII digits, a to z, and anything outside ASCII (texts are lower-cased first).
PLAIN = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads all bits of a uint64 array."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer chunk needs them."""

    up = _powers(_BASE, 2)
    down = _powers(_BASE_INVERSE, 2)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
        return cls.up, cls.down


@dataclass
class Words:
    """Words of a slice of texts. Word i is ``data[start[i]:end[i]]``; text r has the words ``first[r]:first[r + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray  # bytes of text r: bounds[r]:bounds[r + 1]

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + _CHUNK, side="right")))
            low, high = int(self.start[at]), int(self.end[to - 1])
            up, down = _Powers.of(high - low + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(_CODE[self.data[low:high]] * up[: high - low], out=sums[1:])
            a, b = self.start[at:to] - low, self.end[at:to] - low
            out[at:to] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * U64(0xD6E8FEB86659FD93))
            at = to
        return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offset of each row in them; a null has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(texts: pa.Array, word_bytes: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, offsets = bytes_of(texts)
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    begins, ends = inside.copy(), inside.copy()
    if len(inside):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]  # a word never runs on into the next text
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def slices(batch: pa.RecordBatch, column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes of text each; a longer text makes a run of its own."""
    if not batch.num_rows:
        return
    _, offsets = bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, min(to, batch.num_rows) - at)
        at = to


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 values are over fewer words and meaningless."""
    n = len(hashes)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= U64(_BASE)
        out[: max(n - j, 0)] += hashes[j:]
    return mix(out)
