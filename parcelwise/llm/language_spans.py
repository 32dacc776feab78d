"""Language identification word by word: script ranges narrow the candidates, Viterbi labels spans of mixed text.

Learning counts, for every language, the byte 1- to 4-grams of its words (with a mark at both word ends) in ``BUCKETS``
hashed buckets, and its words by script; tasks count, Spark adds up, and the model that comes back has
languages x buckets numbers whatever the input. A word's score for a language is the sum of its grams' log shares over
the four orders, and is out of reach for languages that do not write in the word's script
(read from its letters' code points; quotes, marks and digits have none). In each document the best path
of labels pays ``PENALTY`` for a switch of language between two words. Documents of a task are stepped together, word
1 of all, word 2 of all, and so on, so the work is numpy over the batch and no text is cut.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and no spans; a script that no learned
language uses leaves all languages open; ties go to the language that sorts first; rows with null lang are not learned from;
with nothing learned all texts are ``und``; repeated rows get equal results; empty tables give empty results; only the
named columns are read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelwise.llm.words import SPACED, Words, find_words, mix, slices

BUCKETS = 1 << 15
ORDERS = 4
PENALTY = 6.0
SLICE_BYTES = 6 << 20
#: A language writes in a script if so much of its words do.
SCRIPT_SHARE = 1e-3
LATIN = 1


@cache
def script_table() -> tuple[list[str], np.ndarray]:
    """(names, number of the script of every code point). Only letters have a script, the first word of their character's name.

    Forms of another character (fullwidth, mathematical, ordinal signs) count as that one; both kana are one script; modifier letters,
    marks, digits and signs have none.
    """
    found: dict[str, list[int]] = {}
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        if unicodedata.category(letter) in ("Lu", "Ll", "Lt", "Lo"):
            name = unicodedata.name(unicodedata.normalize("NFKC", letter)[0], "OTHER").split(" ")[0]
            found.setdefault("KANA" if name in ("HIRAGANA", "KATAKANA") else name, []).append(point)
    names = ["none", "LATIN", *sorted(found.keys() - {"LATIN"})]
    table = np.zeros(sys.maxunicode + 1, np.uint16)
    for number, name in enumerate(names[1:], 1):
        table[found[name]] = number
    return names, table


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one place of each distinct word, which distinct word each word is, how often each occurs)."""
    _, place, which, counts = np.unique(words.hashes(), return_index=True, return_inverse=True, return_counts=True)
    return place, which, counts


def _laid_out(words: Words, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words with a space before and after each, and where each begins."""
    length = words.end[place] - words.start[place] + 2
    begin = np.concatenate(([0], np.cumsum(length)))
    out = np.full(begin[-1], 0x20, np.uint8)
    owner = np.repeat(np.arange(len(place)), length - 2)
    inner = np.arange(len(owner)) - np.repeat(begin[:-1] - 2 * np.arange(len(place)), length - 2)
    out[begin[owner] + 1 + inner] = words.data[words.start[place][owner] + inner]
    return out, begin


def gram_buckets(data: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (number of the word, bucket) of every gram inside a word's bytes and marks."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    key = np.zeros(len(data), np.uint64)
    for n in range(1, ORDERS + 1):
        key = key[: len(data) - n + 1] << np.uint64(8) | data[n - 1 :].astype(np.uint64)
        inside = owner[: len(key)] == owner[n - 1 :]
        yield owner[: len(key)][inside], (mix(key[inside] + np.uint64(n << 40)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_scripts(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The script of each word: that of its first letter outside Latin, else Latin, else none."""
    of_point = script_table()[1]
    out = np.zeros(len(begin) - 1, np.uint16)
    owner = np.repeat(np.arange(len(out)), np.diff(begin))
    out[owner[of_point[np.minimum(data, 0x7F)] == LATIN]] = LATIN
    # code points beyond ASCII, from their UTF-8 bytes
    at = np.flatnonzero(data >= 0xC0)
    ahead = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32)
    lead, (a, b, c) = ahead[at], (ahead[at + i] & 0x3F for i in (1, 2, 3))
    two, three, four = (lead & 0x1F) << 6 | a, (lead & 0x0F) << 12 | a << 6 | b, (lead & 0x07) << 18 | a << 12 | b << 6 | c
    script = of_point[np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))]
    out[owner[at[script == LATIN]]] = LATIN
    foreign = at[script > LATIN]
    word, first = np.unique(owner[foreign], return_index=True)
    out[word] = script[script > LATIN][first]
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_share: np.ndarray  # buckets x languages
    candidates: np.ndarray  # scripts x languages

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(scores of every word, words x languages; its letters' weight)."""
        place, which, _ = _distinct(words)
        data, begin = _laid_out(words, place)
        total = np.zeros((len(place), len(self.languages)), np.float32)
        for owner, bucket in gram_buckets(data, begin):
            first = np.searchsorted(owner, np.arange(len(place)))
            has = first < np.append(first[1:], len(owner))
            if has.any():
                total[has] += np.add.reduceat(self.log_share[bucket], first[has], axis=0)
        total /= ORDERS
        script = word_scripts(data, begin)
        total = np.where(self.candidates[script], total, -1e4).astype(np.float32)
        total[script == 0] = 0
        weight = np.where(script == 0, 0, words.end[place] - words.start[place]).astype(np.int64)
        return total[which], weight[which]


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of every word; text r has the words first[r]:first[r + 1]."""
    n_labels = scores.shape[1]
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, left = first[:-1][order], -length[order]
    longest = int(length.max()) if len(length) else 0
    kind = np.min_scalar_type(max(n_labels - 1, 0))  # holds every label's number
    came = np.zeros(scores.shape, kind)
    same = np.arange(n_labels)
    best = np.zeros((len(order), n_labels), np.float32)
    active = np.searchsorted(left, -np.arange(longest), side="left")
    for t in range(longest):
        n = active[t]
        at = begin[:n] + t
        b = best[:n]
        if t:
            top = b.argmax(axis=1)
            jump = b[np.arange(n), top][:, None] - penalty
            switch = jump > b
            came[at] = np.where(switch, top[:, None], same)
            b = np.maximum(b, jump)
            b -= b.max(axis=1, keepdims=True)
        best[:n] = b + scores[at]
    label = np.zeros(len(scores), kind)
    now = best.argmax(axis=1).astype(kind)
    for t in range(longest - 1, -1, -1):
        at = begin[: active[t]] + t
        label[at] = now[: active[t]]
        now[: active[t]] = came[at, now[: active[t]]]
    return label


def fit(docs: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts over all documents that meet ``where`` (a condition on ``id``) and have a language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = (rows if where is None else rows.where(where)).select("lang", "text")

    n_scripts = len(script_table()[0])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 1):
                langs = pd.Series(part.column(0).to_pandas()).astype(object)
                for lang in langs.unique():
                    words = find_words(part.column(1).filter(pa.array((langs == lang).to_numpy())), SPACED, lower=True)
                    if not len(words):
                        continue
                    place, _, counts = _distinct(words)
                    data, begin = _laid_out(words, place)
                    mine = grams.setdefault(lang, np.zeros(BUCKETS + n_scripts, np.int64))
                    for owner, bucket in gram_buckets(data, begin):
                        mine[:BUCKETS] += np.bincount(bucket, counts[owner], BUCKETS).astype(np.int64)
                    mine[BUCKETS:] += np.bincount(word_scripts(data, begin), counts, n_scripts).astype(np.int64)
        for lang, mine in grams.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(mine[used])], names=["lang", "bucket", "n"])

    found = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((BUCKETS + n_scripts, len(languages)))
    table[found["bucket"], np.searchsorted(languages, found["lang"])] = found["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    log_share = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)) if languages else grams
    written = scripts[1:].sum(axis=0)
    candidates = scripts >= np.maximum(SCRIPT_SHARE * written, 1)
    candidates[~candidates.any(axis=1)] = True
    return LanguageModel([str(x) for x in languages], log_share.astype(np.float32), candidates)


def label_spans(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every text.

    ``spans``: runs of words of one language as (first word, number of words, lang). ``lang_pred`` has most bytes in words
    with letters, ``score`` is its share of them.
    """
    names = np.array([*model.languages, "und"], object)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                words = find_words(part.column(1), SPACED, lower=True)
                open_ = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                n_langs = len(model.languages)
                if not n_langs:
                    open_[:] = False
                scores, weight = model.word_scores(words) if n_langs and len(words) else (np.zeros((len(words), 1), np.float32), np.zeros(len(words), np.int64))
                label = viterbi(scores, words.first)
                rows = words.rows()
                share = np.bincount(rows * max(n_langs, 1) + label, weight, len(open_) * max(n_langs, 1)).reshape(len(open_), -1)
                pred, total = share.argmax(axis=1), share.sum(axis=1)
                score = np.where(open_, share.max(axis=1) / np.maximum(total, 1), 0.0)
                pred[~open_] = n_langs
                ok = open_[rows] if len(rows) else np.zeros(0, bool)
                turn = np.ones(len(label), bool)
                turn[1:] = (label[1:] != label[:-1]) | (rows[1:] != rows[:-1])
                begin = np.flatnonzero(turn & ok)
                stop = np.append(np.flatnonzero(turn), len(label))
                size = stop[np.searchsorted(stop, begin) + 1] - begin if len(begin) else begin
                spans = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(rows[begin], np.arange(len(open_) + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array((begin - words.first[rows[begin]]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(list(names[label[begin]]), pa.string())],
                        names=["start", "words", "lang"],
                    ),
                )
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(names[pred]), pa.string()), pa.array(score), spans], names=["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {id_type}, lang_pred string, score double, spans array<struct<start:int,words:int,lang:string>>")
