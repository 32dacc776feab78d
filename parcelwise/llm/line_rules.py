"""Quality rules, lines first: judge every line, take out those that fail, then judge what is left of the document.

Only DataFrame expressions, and all of them look at one row: no shuffle, no Python. A text is split into lines and words
once; windows of words are compared by 64-bit hashes within their document. The costly exact count of
repeated words runs only where the distinct windows are fewer than the windows.

Line rules, in this order (``LINE_RULES`` lists the shares):

* symbols: too many of ``#*$%&|<>`` for its words, which takes in menus whose entries are set apart by bars;
* shouting: too many words with doubled exclamation marks, or three words and more without a small letter;
* stutter: a long line with few different words;
* navigation: under five words and no closing mark, like a menu entry or a button;
* punctuation: five words and more without any punctuation;
* boilerplate: equal to an earlier line of the document, or a known phrase of page furniture.

Defined results: a null or empty text, or one of white space, has no words and fails the base rules; repeated rows give
repeated results; empty tables give empty results; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Shares of a line's words from which a rule fails it, and of a document's words that have to stay.
LINE_RULES = {"symbols": 0.25, "shouting": 0.25, "stutter": 0.4, "stutter_words": 16, "kept_words": 0.5}
#: Phrases of page furniture; a line of under 20 words with one of them fails.
FURNITURE = ["all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here", "read more", "sign up", "log in"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text between ASCII spaces, as an array; empty for null."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def repeated_words(windows: Column) -> Column:
    """Words within windows that occur twice or more, from the windows' hashes in order of place."""

    def places(s: Column) -> Column:
        at = F.transform(
            s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])
        )
        return F.sort_array(F.filter(at, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        return F.aggregate(
            at, none,
            lambda a, i: F.struct((i + WINDOW).alias("end"), (a["total"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("total")),
        )["total"]

    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(ranked, places), covered)


def _line(raw: Column) -> Column:
    """What the rules need of one line."""
    return let(
        words_of(raw),
        lambda w: F.struct(
            raw.alias("line"), F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct"), F.regexp_count(raw, F.lit(SYMBOLS)).alias("symbols"),
        ),
    )


def _fails(x: Column, earlier: Column) -> Column:
    """The first rule that a line with words fails, or null."""
    line, words, low = x["line"], x["words"], F.lower(x["line"])
    r = LINE_RULES
    return (
        F.when(x["symbols"] >= r["symbols"] * words, "symbols")
        .when((F.regexp_count(line, F.lit("!!")) >= r["shouting"] * words) | ((words >= 3) & (line != low) & (line == F.upper(line))), "shouting")
        .when((words >= r["stutter_words"]) & (x["distinct"] <= r["stutter"] * words), "stutter")
        .when((words < 5) & ~line.rlike(r"[.!?…][\"')\]»”]*[\x20\x09-\x0D]*\z"), "navigation")
        .when((words >= 5) & ~line.rlike(r"[.,;:!?…。।]"), "punctuation")
        .when(earlier | ((words < 20) & low.rlike("|".join(FURNITURE))), "boilerplate")
    )


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_kept_words, kept, clean_text, failed_rules)."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = df.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.length(F.array_join("words", "")), F.lit(0)).cast("long").alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.transform(F.split("text", "\n"), _line).alias("lines"),
    )
    windows = F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + j) for j in range(WINDOW)]),
        )
    )
    df = df.select(
        "doc_id", "n_words", "word_chars", windows.alias("windows"),
        F.aggregate("lines", F.lit(0), lambda a, x: a + x["symbols"]).cast("long").alias("n_symbols"),
        F.filter("lines", lambda x: x["words"] > 0).alias("lines"),
    )
    seen = F.transform("lines", lambda x: x["line"])
    df = df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "lines",
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(repeated_words(F.col("windows"))).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct(seen)).alias("n_distinct_lines"),
    )
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # a line's first place tells whether it was there before; looked up only where a document repeats lines
    repeats = F.col("n_distinct_lines") < F.size("lines")
    judged = let(
        F.when(repeats, F.sort_array(F.transform("lines", lambda x, k: F.struct(x["line"].alias("line"), k.alias("k"))))),
        lambda s: F.when(s.isNull(), F.array().cast("array<int>")).otherwise(
            F.filter(F.transform(s, lambda x, k: F.when(F.get(s, k - 1)["line"] == x["line"], x["k"])), lambda k: k.isNotNull())
        ),
    )
    df = df.select("*", base_failed.alias("base_failed"), F.map_from_arrays(judged, judged).alias("earlier"))
    df = df.select(
        "*", F.transform("lines", lambda x, k: F.struct(x["line"].alias("line"), x["words"].alias("words"), _fails(x, F.map_contains_key(F.col("earlier"), k)).alias("rule"))).alias("judged"),
    )
    passed = F.filter("judged", lambda x: x["rule"].isNull())
    n_kept = F.aggregate(passed, F.lit(0), lambda a, x: a + x["words"])
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.col("n_distinct_lines")).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "base_failed", n_kept.cast("long").alias("n_kept_words"),
        (~F.col("base_failed") & (n_kept >= LINE_RULES["kept_words"] * F.col("n_words"))).alias("kept"),
        F.array_join(F.transform(passed, lambda x: x["line"]), "\n").alias("clean_text"),
        F.filter(F.transform("judged", lambda x: x["rule"]), lambda r: r.isNotNull()).alias("failed_rules"),
    )
