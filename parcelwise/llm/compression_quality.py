"""Quality classifier by compression: which of two dictionaries, made from good and from bad text, says more about a text?

Fitting takes a bounded sample of labelled rows (``per_class`` documents of each label, those with the smallest hash of their id,
and ``piece_bytes`` of each, spread over the whole text; both are parameters). Half of it trains one zstandard dictionary
for each label, the other half calibrates: a text's feature is the difference of its two compressed sizes over their
sum, and a logistic curve, fitted on those of known label, turns it into a score from 0 to 1. The two dictionaries and
the three numbers of the curve are the whole model, a few hundred kB whatever the input. Scoring reads every whole text
once, in its own task.

Defined results: a null or empty text gets the score of feature 0, like a text both dictionaries fit equally; rows
without a label, or with a null id, are not learned from; with no row of one label every score is the share of label 1 (0.5
without labels); repeated rows get equal scores; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

#: Texts are compressed in pieces this long, so that the dictionary and not the text's own past decides.
PIECE = 1024


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    level: int

    def features(self, texts: pa.Array) -> np.ndarray:
        """(bad size - good size) / (bad size + good size) of each text; 0 for an empty one."""
        if not self.good or not self.bad:
            return np.zeros(len(texts))
        coders = [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=self.level, write_content_size=False, write_checksum=False, write_dict_id=False)
            for d in (self.good, self.bad)
        ]
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            raw = (text.as_py() or "").encode()
            if raw:
                good, bad = (sum(len(c.compress(raw[at : at + PIECE])) for at in range(0, len(raw), PIECE)) for c in coders)
                out[i] = (bad - good) / (bad + good)
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * self.features(texts), -50, 50)))


def _spread(text: str, most: int) -> bytes:
    """At most ``most`` bytes of a text: pieces at even distances."""
    raw = text.encode()
    if len(raw) <= most:
        return raw
    n = max(1, most // PIECE)
    return b"".join(raw[at : at + most // n] for at in np.linspace(0, len(raw) - most // n, n).astype(int))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method, both labels weighted by their counts."""
    scale = x.std() or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T * (p * (1 - p)) @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w = w + step
        if abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", where: Column | None = None,
    per_class: int = 3000, piece_bytes: int = 16_384, dict_bytes: int = 32_768, level: int = 3,
) -> CompressionModel:
    """``where``: a condition on ``id`` that a labelled row must meet to be learned from."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    known = known if where is None else known.where(where)
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = np.clip(counts.get(1, 0) / total if total else 0.5, 1e-6, 1 - 1e-6)
        return CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))), level)
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = F.udf(lambda t: _spread(t or "", piece_bytes), "binary")
    sample = texts.join(F.broadcast(chosen), "id").select("id", "label", cut("text").alias("text")).collect()
    halves: dict[tuple[int, int], list[bytes]] = {(label, half): [] for label in (0, 1) for half in (0, 1)}
    for i, r in enumerate(sorted(sample, key=lambda r: (r["label"], r["id"]))):
        if r["text"]:
            halves[r["label"], i % 2].append(bytes(r["text"]))
    dictionaries = [_dictionary(halves[label, 0], dict_bytes) for label in (1, 0)]
    model = CompressionModel(*dictionaries, 1.0, 0.0, level)
    held = [(t, label) for label in (0, 1) for t in halves[label, 1]]
    x = model.features(pa.array([t.decode("utf-8", "ignore") for t, _ in held], pa.string()))
    y = np.array([label for _, label in held], float)
    if len(set(y)) < 2:
        return CompressionModel(b"", b"", 0.0, 0.0, level)
    slope, intercept = _logistic(x, y)
    # the sample holds both labels in other shares than the labelled rows do
    intercept += float(np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return CompressionModel(*dictionaries, slope, intercept, level)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too little text for training, the text itself."""
    pieces = [t[at : at + PIECE] for t in texts for at in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:] or b" " * 8


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every text; predicted is 1 from ``threshold`` on."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judge, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, model: CompressionModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more; decided where the rows are read."""
    at = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) >= threshold))

    return docs.mapInArrow(judge, docs.schema)
