"""URL filters: all glob rules at once, as one bit-parallel automaton.

Every pattern is laid out in the bits of a row of 64-bit words: one start bit and one bit for each element. A byte
of the URL moves all patterns one step with a shift and two masks (Shift-And): ``step[c]`` has the bits that c may
enter, ``stay[c]`` the bits that a wildcard holds while it swallows c. Tasks step a whole batch of URLs in one go,
URLs of one length after another, so the cost is (longest URL) x (a few array operations) and any URL length works.

Pattern language, over the canonical URL ``.host/path``: ``**`` any bytes, ``*`` any bytes but ``/``, ``?`` one byte
but ``/``; everything else stands for itself.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; repeated rows give
repeated results; an empty table gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelwise.llm.words import bytes_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return f"*.{self.host}{self.path}**"


@dataclass(frozen=True)
class Automaton:
    step: np.ndarray  # 256 x words
    stay: np.ndarray  # 256 x words
    start: np.ndarray  # words
    final: np.ndarray  # bit number for each pattern


def compile_globs(patterns: list[str]) -> Automaton:
    """Lay the patterns out one after another; the bit after a pattern's last element is the next one's start bit."""
    steps, stays, starts, finals = [], [], [], []
    not_slash = np.array([b != 0x2F for b in range(256)])
    for pattern in patterns:
        starts.append(len(steps))
        steps.append(np.zeros(256, bool))
        stays.append(np.zeros(256, bool))
        raw, i = pattern.encode(), 0
        while i < len(raw):
            if raw[i : i + 2] == b"**":
                stays[-1] = np.ones(256, bool)
                i += 2
            elif raw[i : i + 1] == b"*":
                stays[-1] = stays[-1] | not_slash
                i += 1
            else:
                steps.append(not_slash if raw[i : i + 1] == b"?" else np.arange(256) == raw[i])
                stays.append(np.zeros(256, bool))
                i += 1
        finals.append(len(steps) - 1)
    width = max(1, -(-len(steps) // 64))

    def pack(bits: list[np.ndarray]) -> np.ndarray:
        table = np.zeros((256, width * 64), bool)
        if bits:
            table[:, : len(bits)] = np.stack(bits, axis=1)
        return np.packbits(table, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    first = np.zeros(width * 64, bool)
    first[starts] = True
    return Automaton(pack(steps), pack(stays), np.packbits(first, bitorder="little").view("<u8").astype(np.uint64), np.array(finals, int))


def run_automaton(a: Automaton, texts: pa.Array) -> np.ndarray:
    """Booleans, one row a text and one column a pattern: does the pattern fit the whole text?"""
    data, offsets = bytes_of(texts)
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")
    begin, left = offsets[:-1][order], -length[order]
    state = np.tile(a.start, (len(order), 1))
    for t in range(-int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(left, -t, side="left"))  # texts with a byte number t
        d, c = state[:n], data[begin[:n] + t]
        shifted = d << np.uint64(1)
        shifted[:, 1:] |= d[:, :-1] >> np.uint64(63)
        state[:n] = (shifted & a.step[c]) | (d & a.stay[c])
    out = np.empty((len(order), len(a.final)), bool)
    out[order] = (state[:, a.final // 64] >> (a.final % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
    return out


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(
    pages: DataFrame, rules: list[Rule], block: Iterable[str] = (), id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Judge every URL: (page_id, host, path, rule, verdict, fitted).

    The longest rule that fits decides (of equally long ones the first listed). Where none fits, a URL is blocked if
    one of the ``block`` globs fits it and allowed otherwise; ``fitted`` is that glob. The rule list is a parameter
    of the call and bounded by it; pages are never shuffled.
    """
    ranked = sorted(rules, key=lambda r: -len(r.text))
    globs = list(block)
    automaton = compile_globs([r.pattern for r in ranked] + globs)
    texts, verdicts = [r.text for r in ranked] + [None], [r.verdict for r in ranked] + [None]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = run_automaton(automaton, batch.column(3))
            none = np.ones((len(fits), 1), bool)
            rule = np.argmax(np.hstack([fits[:, : len(ranked)], none]), axis=1)
            glob = np.argmax(np.hstack([fits[:, len(ranked) :], none]), axis=1)
            ruled = rule < len(ranked)
            verdict = np.where(ruled, np.array([v or "" for v in verdicts], object)[rule], np.where(glob < len(globs), "block", "allow"))
            fitted = [None if r else (globs + [None])[g] for r, g in zip(ruled, glob)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([texts[i] for i in rule], pa.string()),
                 pa.array(list(verdict), pa.string()), pa.array(fitted, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "fitted"],
            )

    kept = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    id_type = kept.schema["page_id"].dataType.simpleString()
    return kept.withColumn("canonical", F.concat(F.lit("."), "host", "path")).mapInArrow(
        judge, f"page_id {id_type}, host string, path string, rule string, verdict string, fitted string"
    )
