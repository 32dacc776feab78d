"""Operators that judge one row at a time: words, URL filters, line rules, quality, language."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelwise.llm import compression_quality, language_spans, line_rules, url_filters, words
from tests.llm.cases import PLAIN, SPACED, awkward_rows, frame, lower, nothing


def test_words_equal_the_patterns():
    texts = [t for _, t in awkward_rows()]
    column = pa.array(texts)
    for table, pattern, low in ((words.SPACED, SPACED, False), (words.PLAIN, PLAIN, True)):
        w = words.find_words(column, table, lower=low)
        got = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]
        want = [pattern.findall(lower(t) if low else t) if t else [] for t in texts]
        assert got == [x for t in want for x in t] and list(w.counts) == [len(t) for t in want]
        by_word = {}
        for word, h in zip(got, w.hashes()):
            assert by_word.setdefault(word, h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab" * n if n % 5 else None for n in range(60)])], names=["t"])
    parts = list(words.slices(batch, 0, 50))
    assert pa.Table.from_batches(parts).column("t").to_pylist() == batch.column(0).to_pylist() and len(parts) > 5


def _as_regex(glob: str) -> str:
    return "".join({"**": r"[\s\S]*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob, re.S))


def test_automaton_equals_regular_expressions():
    rng = random.Random(1)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "ab"]) for _ in range(rng.randrange(9))) for _ in range(60)] + ["", "é*", "a" * 70 + "*b"]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(12))) for _ in range(300)] + ["", "éa", "a" * 90 + "b", "ab" * 3000]
    fits = url_filters.run_automaton(url_filters.compile_globs(globs), pa.array(texts))
    for i, text in enumerate(texts):
        for j, glob in enumerate(globs):
            # two-byte characters count as two for "?" and stand in no pattern with it here
            assert fits[i, j] == bool(re.fullmatch(_as_regex(glob), text)), (text, glob)


RULES = [url_filters.Rule("allow", "org", "/"), url_filters.Rule("block", "example.org", "/es/"), url_filters.Rule("block", "com", "/de/")]


def test_url_filters(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1?x#y", "http://example.org", "http://badexample.org/es/", "x://com/de/1", "http://u:p@b.com:80/de/", "http://evil.net/x.com/de/",
            "http://a.net/" + "p" * 20_000, "http://casino.net/", "http://a\n.com/de/\n"]
    df = frame(spark, [(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[6])], "page_id").withColumnRenamed("text", "url")
    got = {r["page_id"]: r for r in url_filters.filter_urls(df, RULES, ["*casino*/**"]).collect()}
    assert url_filters.filter_urls(df, RULES).count() == len(urls) + 2
    assert [got[i]["host"] for i in range(5)] == ["", "", "", "a.example.org", "example.org"]
    assert [(got[i]["rule"], got[i]["verdict"]) for i in (3, 4, 5, 6, 7, 8, 10, 11)] == [
        ("example.org/es/", "block"), (None, "allow"), ("org/", "allow"), ("com/de/", "block"), (None, "allow"), (None, "allow"), (None, "block"), ("com/de/", "block")]
    assert url_filters.filter_urls(df.limit(0), RULES).count() == 0


def brute_lines(text):
    w = SPACED.findall(text or "")
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def test_line_rules(spark):
    good = "A sentence of several words, and then another one that ends here with a mark, as it should do.\n" "The next line is of the same kind and says something else altogether about it."
    bad = ["one | two | three | four | five | six " * 5, "LOUD!! WORDS!! ALL!! " * 1 + " ".join(f"X{i}!!" for i in range(40)), " ".join(f"s{i // 8}" for i in range(80))]
    rows = awkward_rows() + [(100, good), *[(200 + i, t) for i, t in enumerate(bad)]]
    got = line_rules.clean_lines(frame(spark, rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(map(repr, ((r["doc_id"], *(r[n] for n in names)) for r in got))) == sorted(map(repr, ((i, *brute_lines(t)) for i, t in rows)))
    kept = {r["doc_id"]: r for r in got}
    assert kept[100]["kept"] and kept[100]["clean_text"] == good and not any(kept[200 + i]["kept"] for i in range(3))
    assert line_rules.clean_lines(nothing(spark)).count() == 0


def test_compression_quality(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice("stone river light under quiet morning garden winter".split()) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(rng.choice("zzz!! buy$$$ xx%% click### qq&& win***".split()) for _ in range(60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(500, None), (501, ""), (None, good[0]), (3, good[3])]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120) if i % 5] + [(None, 1), (7, None)], "doc_id long, quality int")
    docs = frame(spark, rows)
    model = compression_quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in compression_quality.score(docs, model).collect()}
    held = [i for i in range(120) if i % 5 == 0]
    assert all((got[i]["score"] > 0.5) == (i < 60) for i in held)
    assert got[500]["score"] == got[501]["score"] and compression_quality.score(docs, model).count() == len(rows)
    assert compression_quality.keep_good(docs, model).columns == docs.columns
    assert {r["doc_id"] for r in compression_quality.keep_good(docs, model).collect()} >= set(range(60))
    for few, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        one = compression_quality.score(docs, compression_quality.fit(docs, few)).toPandas()["score"]
        assert np.allclose(one, want, atol=1e-5)
    assert compression_quality.score(nothing(spark), model).count() == 0
    texts = pa.array([t for _, t in awkward_rows()])
    assert ((model.scores(texts) >= 0) & (model.scores(texts) <= 1)).all()


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    scores, first = rng.normal(size=(14, 3)).astype(np.float32), np.array([0, 5, 5, 6, 14])
    got = language_spans.viterbi(scores, first, 0.7)
    for a, b in zip(first[:-1], first[1:]):
        best = max(np.ndindex(*[3] * (b - a)), key=lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:])), default=())
        assert tuple(got[a:b]) == best


def test_scripts_go_by_letters():
    names, _ = language_spans.script_table()
    cases = {"„слово“": "CYRILLIC", "…это": "CYRILLIC", "l’été": "LATIN", "người": "LATIN", "“quoted”": "LATIN", "ไทย": "THAI", "हिन्दी": "DEVANAGARI", "カタ": "KANA", "ひら": "KANA",
             "漢字": "CJK", "한국": "HANGUL", "ＡＢＣ": "LATIN", "n.º": "LATIN", "12—3…": "none", "😀": "none", "𐐀": "DESERET", "aж": "CYRILLIC", "λж": "GREEK", "": "none"}
    words = [w.encode() for w in cases]
    data = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    begin = np.cumsum([0] + [len(w) + 2 for w in words])
    assert [names[i] for i in language_spans.word_scripts(data, begin)] == list(cases.values())
    assert len(language_spans.word_scripts(np.zeros(0, np.uint8), np.zeros(1, np.int64))) == 0


def test_quoted_words_keep_their_language(spark):
    learned = [(i, t, lang) for i in range(8) for t, lang in (("это простой русский текст и слова", "ru"), ("this is plain english text and words", "en"))]
    model = language_spans.fit(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "„русский“ …текст и слова»"), (2, "“plain” …text’s words—and")], "doc_id long, text string")
    assert {r["doc_id"]: (r["lang_pred"], len(r["spans"])) for r in language_spans.label_spans(asked, model).collect()} == {1: ("ru", 1), 2: ("en", 1)}


def test_viterbi_of_more_labels_than_a_byte_holds():
    scores = np.eye(300, dtype=np.float32)
    for first in (np.arange(301), np.array([0, 300])):
        assert (language_spans.viterbi(scores, first, 0.1) == np.arange(300)).all()


def test_language_spans(spark):
    rng = random.Random(4)
    kinds = {"aa": "thand ing the of wher tion and".split(), "bb": "uñaz ción que ado llar los".split(), "ru": "привет мир как дела".split()}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(30)), k) for i, k in enumerate(list(kinds) * 20)]
    docs = spark.createDataFrame(rows + [(900, "the of and", None)], "doc_id long, text string, lang string").selectExpr("*", "'q' AS bucket", "'q' AS n")
    model = language_spans.fit(docs, where=docs["doc_id"].isNull() | True)
    mixed = " ".join([*kinds["aa"], *kinds["bb"], *kinds["ru"] * 2])
    tests = awkward_rows() + [(300, mixed), (301, "123 456 !!"), (302, "שלום"), (303, "МИР как")]
    got = {r["doc_id"]: r for r in language_spans.label_spans(frame(spark, tests), model).collect()}
    assert [(s["words"], s["lang"]) for s in got[300]["spans"]] == [(7, "aa"), (6, "bb"), (8, "ru")]
    assert (got[301]["lang_pred"], got[301]["score"], got[301]["spans"]) == ("und", 0.0, [])
    assert got[302]["lang_pred"] in kinds and got[303]["lang_pred"] == "ru"
    assert got[1]["lang_pred"] == "und" and language_spans.label_spans(frame(spark, tests), model).count() == len(tests)
    empty = language_spans.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_spans.label_spans(docs, empty).collect()} == {"und"}
    assert language_spans.label_spans(nothing(spark), model).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_spans.fit(docs.where("doc_id % 4 <> 2"))
    held = language_spans.label_spans(docs.where("doc_id % 4 = 2"), model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = compression_quality.fit(docs, labels.where("doc_id % 5 <> 0"))
    held = compression_quality.score(docs.where("doc_id % 5 = 0"), model).join(labels, "doc_id").toPandas()
    rank = held["score"].rank()
    good = held["quality"] == 1
    assert (rank[good].mean() - (good.sum() + 1) / 2) / (~good).sum() > 0.93
    assert held["predicted"][good].mean() > 0.98


@pytest.mark.parametrize("text", [None, "", "x"])
def test_single_rows(spark, text):
    one = frame(spark, [(1, text)])
    assert line_rules.clean_lines(one).count() == 1
