"""Shared small inputs: rows that every operator has to take, and plain versions of the word rules."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Names that operators use inside; as extra columns they must do no harm.
CLASHING = ["row", "id", "text_key", "start", "windows", "words", "lines", "size", "c", "x", "u", "v", "key", "gram", "grams", "component", "shard", "node", "d0", "items", "fp"]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(rng.choice(["w%d", "W%d.", "é%d", "x%d,"]) % rng.randrange(vocabulary) for _ in range(n))


def awkward_rows(seed: int = 5) -> list[tuple]:
    """(doc_id, text): nulls, empty and very long texts, repeated rows, copies, near copies, shared passages."""
    rng = random.Random(seed)
    base, passage = prose(rng, 130, 5000), prose(rng, 70, 5000)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    far = " ".join([*words[:40], *(f"n{i}" for i in range(50)), *words[90:]])
    texts = [None, "", " \t\r\n\x0b\x0c ", "one", "One two  three", base, base, near, far, passage, f"start here {passage} and end", f"{passage}\n{passage}",
             prose(rng, 4000, 200), "a" * 50_000, "the " * 300, "ünïcödé \u00a0 ñandú 漢字\u2028x", "\x00 null byte <|endoftext|> #$%", base.upper()]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, base), (9, passage), (None, base), (None, passage), (None, None), (40, prose(rng, 30)), (41, prose(rng, 9))]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, id_col: str = "doc_id", clash: bool = True):
    """The rows as a table of several partitions, with extra columns."""
    df = spark.createDataFrame(rows, f"{id_col} long, text string").repartition(3)
    return df.selectExpr("*", *[f"'zz' AS `{c}`" for c in CLASHING if c != id_col]) if clash else df


def nothing(spark, id_col: str = "doc_id"):
    return spark.createDataFrame([], f"{id_col} long, text string")
