"""Source divergence, whitening and license scan, against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import re
from pyspark.sql import functions as F

from parcelwise.llm import divergence, license_scan, queries, whitening
from tests.llm.cases import CLASHING, PLAIN, awkward_rows, frame, lower, nothing, prose

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, least, top=10):
    """Rows are (lang, source, text)."""
    held, seen, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERMS.findall(lower(text or ""))
        held[lang, source].update(terms)
        seen[lang].update(set(terms))
        total[lang].update(terms)
    out = []
    for lang in {k for k, _ in held}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = [s for k, s in held if k == lang]

        def p(counts):
            below = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // below for t in kept}

        q, ps = p(total[lang]), {s: p(held[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((ps[s][t] - ps[o][t]) ** 2 // (ps[s][t] + ps[o][t]) for t in kept)) for o in sources if o != s]
            over = [(t, (ps[s][t] - q[t]) ** 2 // (ps[s][t] + q[t])) for t in kept if held[lang, s][t] and ps[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", over)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def audit_frame(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    return df.selectExpr("*", "1 AS n", "2 AS docs", "'zz' AS term", "'zz' AS counts", "'zz' AS block", "'zz' AS total", "3 AS tile")


@pytest.mark.parametrize("least,block,tile", [(1, 8192, 48), (3, 5, 2), (10, 3, 1)])
def test_divergence(spark, monkeypatch, least, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    rng = random.Random(least)
    rows = [(rng.choice(["en", "de", None, "alone"][:3]), rng.choice(["s1", "s2", "é", "", None, "s10"]), t) for _, t in awkward_rows() * 2]
    rows += [("en", rng.choice(["s1", "s1", "s1", "s2", "s3"]), " ".join(rng.choice(["Alpha", "beta", "gamma1x", "é%d" % rng.randrange(9), "zeta" * rng.randrange(1, 5)]) for _ in range(rng.randrange(40)))) for _ in range(60)]
    rows += [("alone", "only", "one two one"), ("empty", "a", None), ("empty", "b", "12 34"), ("empty", "c", "unseen elsewhere")]
    got = divergence.audit(audit_frame(spark, rows), least).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, least)


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(empty).count() == 0


def test_runs_cover_every_column():
    rng = np.random.default_rng(3)
    for _ in range(50):
        entries, sources = int(rng.integers(1, 12)), int(rng.integers(1, 5))
        table = rng.integers(0, 3, (sources, entries))
        table[:, 0] = np.where(table.sum(axis=1) == 0, 1, table[:, 0])  # each source has a cell
        weights = rng.integers(1, 4, entries)
        source, entry = np.nonzero(table)
        mixed = rng.permutation(len(source))
        first, stop, value = divergence.encode_block(np.cumsum(weights), entry[mixed], source[mixed], table[source, entry][mixed], sources)
        for s in range(sources):
            ends, counts = stop[first[s] : first[s + 1]], value[first[s] : first[s + 1]]
            assert np.repeat(counts, np.diff(ends, prepend=0)).tolist() == np.repeat(table[s], weights).tolist()
            assert (counts[1:] != counts[:-1]).all()  # no run could be longer


def test_shares_beyond_64_bits(spark):
    counts = [0, 5, 10**10, 4 * 10**18]
    want = [1 + 10**9 * (c + 2) // (5 * 10**18 + 8) for c in counts]
    assert divergence.shares(np.array(counts, np.int64), 5 * 10**18, 4).tolist() == want
    df = spark.createDataFrame([(c, 5 * 10**18, 4) for c in counts], "c long, total long, terms long")
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("total"), F.col("terms"))).collect()] == want


# --- whitening ---


def brute_whitening(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    n, mean = len(x), x.mean(axis=0)
    v = (x - mean).T @ (x - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, (x - mean) @ u / np.sqrt(e), e / np.trace(v), ((x * n - x.sum(axis=0)) ** 2).sum(axis=1)


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_updates_give_the_scatter(block):
    rng = np.random.default_rng(block)
    for rows in (
        (rng.normal(size=(120, 9)) * 300).astype(np.int64) + 100_000, np.full((20, 5), 7), np.repeat(np.arange(6)[:, None], 4, axis=1), np.eye(6, dtype=np.int64)[np.arange(60) % 6],
        np.arange(7)[:, None], np.array([[3, 4]]), rng.integers(0, 2, (40, 30)), np.diag([1, 10**6, 1, 5])[np.arange(9) % 4],
    ):
        rows = rows.astype(np.int64)
        one, a, b = (whitening.Spectrum.empty(rows.shape[1]) for _ in range(3))
        one.add_rows(rows, block)
        a.add_rows(rows[: len(rows) // 3], block)
        b.add_rows(rows[len(rows) // 3 :], block)
        a.add(b)
        centred = rows - rows.mean(axis=0)
        for s in (one, a):
            size = max(1.0, np.abs(centred.T @ centred).max())
            assert s.n == len(rows) and s.sums.tolist() == rows.sum(axis=0).tolist()
            assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - centred.T @ centred).max() < 1e-10 * size
            assert np.abs(s.vectors.T @ s.vectors - np.eye(rows.shape[1])).max() < 1e-11


def test_secular_roots_are_eigenvalues():
    rng = np.random.default_rng(4)
    for k in (1, 2, 5, 40):
        poles = np.sort(rng.normal(size=k) * 10.0 ** rng.integers(-6, 6, k))
        z = rng.normal(size=k) * 10.0 ** rng.integers(-5, 1, k)
        z /= np.linalg.norm(z)
        near, tau = whitening.secular_roots(poles, z * z, 2.5)
        want = np.linalg.eigvalsh(np.diag(poles) + 2.5 * np.outer(z, z))
        assert np.abs(poles[near] + tau - want).max() <= 1e-12 * max(1, np.abs(want).max())


def vectors_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    return df.selectExpr("*", "'zz' AS vector", "1 AS part", "'zz' AS n", "'zz' AS place", "2 AS component", "'zz' AS whitened", "'zz' AS deviation")


def test_whitening(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(90, 12)) * np.linspace(0.05, 0.4, 12)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[0]), (None, good[1]), (3, good[3])]
    bad = [(100, None), (101, []), (102, [float("nan")] * 12), (103, [float("inf")] + [0.0] * 11), (104, [None] + [0.0] * 11), (105, [1.0, 2.0])]
    df = vectors_frame(spark, rows + bad)
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    n, want, explained, deviation = brute_whitening([v for _, v in rows], 8)
    assert model.n == n == 93 and model.identity_error < 1e-9 and len(got) == 93
    assert np.allclose(model.eigenvalues / model.trace, explained, rtol=1e-12)
    by = defaultdict(list)
    for i, r in enumerate(rows):
        by[r[0]].append((int(deviation[i]), want[i]))
    sign = None
    for r in sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"])):
        exact, w = by[r["vec_id"]][0]
        assert int(r["deviation"]) == exact
        sign = np.sign(w) * np.sign(r["whitened"]) if sign is None else sign
        assert np.allclose(np.array(r["whitened"]) * sign, w, atol=1e-9)
    whole = np.array([r["whitened"] for r in got])
    assert np.abs(whole.T @ whole / n - np.eye(8)).max() < 1e-9
    # block by block and row by row give the same values
    again = whitening.fit(df, block=1)
    assert np.allclose(again.eigenvalues, model.eigenvalues, rtol=1e-12) and np.allclose(np.abs(again.components), np.abs(model.components), atol=1e-9)


def test_whitening_without_variance_and_beyond_64_bits(spark):
    flat = vectors_frame(spark, [(i, [0.5, float(i % 3), 1.0]) for i in range(9)])
    model = whitening.fit(flat)
    rows = whitening.whiten(flat, model).collect()
    assert [x is None for x in rows[0]["whitened"]] == [False, True, True] and model.identity_error < 1e-9
    same = vectors_frame(spark, [(i, [0.5]) for i in range(4)])
    assert [r["whitened"] for r in whitening.whiten(same, whitening.fit(same)).collect()] == [[None]] * 4
    wide = vectors_frame(spark, [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [3.0, 2.0])])
    model = whitening.fit(wide)
    x = [[(1 << 52) + 100_000, 100_000], [-(1 << 52) + 100_000, 101_024], [103_072, 102_048]]
    s = [sum(c) for c in zip(*x)]
    want = sorted(sum((3 * a - b) ** 2 for a, b in zip(row, s)) for row in x)
    assert sorted(int(r["deviation"]) for r in whitening.whiten(wide, model).collect()) == want


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None)]):
        df = vectors_frame(spark, rows)
        model = whitening.fit(df)
        assert model.n == 0 and whitening.whiten(df, model).count() == 0


def test_whitening_query(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.op12_secular_whitening(spark, sf)
    got = df.orderBy("vec_id", "component").collect()
    vectors = [r["embedding"] for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    n, want, explained, deviation = brute_whitening(vectors, 8)
    assert len(got) == 8 * n and {r["identity_error"] <= 1e-9 for r in got} == {True}
    assert [r["deviation"] for r in got[::8]] == [int(d) for d in deviation]
    assert np.allclose([r["explained"] for r in got[:8]], explained, rtol=1e-10)
    table = np.array([r["whitened"] for r in got]).reshape(n, 8)
    assert np.abs(np.abs(table.T @ want / n) - np.eye(8)).max() < 1e-8


# --- license scan ---

LONG = "Permission granted to use copy and share this small work for any purpose with no fee at all"
TEMPLATES = [license_scan.Template("mit", "MIT License", True), license_scan.Template("x", "x", True), license_scan.Template("long", LONG), license_scan.Template("five", "a b a b a")]


def brute_scan(text, templates):
    w = PLAIN.findall(lower(text or ""))
    spans = []
    for number, template in enumerate(templates):
        t = PLAIN.findall(lower(template.text))
        k = min(4, len(t))
        lines = defaultdict(set)
        for i in range(len(w) - k + 1):
            for j in range(len(t) - k + 1):
                if w[i : i + k] == t[j : j + k]:
                    lines[i - j].add(j)
        clusters = []
        for d in sorted(lines):
            if clusters and d - clusters[-1][-1] <= min(8, max(0, len(t) - 4)):
                clusters[-1].append(d)
            else:
                clusters.append([d])
        for cluster in clusters:
            votes = set().union(*(lines[d] for d in cluster))
            at = [(j, j + d) for j in range(len(t)) for d in cluster if 0 <= j + d < len(w) and w[j + d] == t[j]]
            n = len({j for j, _ in at})
            if 100 * len(votes) >= 25 * (len(t) - k + 1) and 100 * n >= (80 if len(t) > 4 else 100) * len(t):
                spans.append((number, min(i for _, i in at), max(i for _, i in at) + 1, n))
    return len(w), sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def license_rows():
    rng = random.Random(6)
    words = LONG.split()
    texts = [LONG, LONG.upper(), f"before {LONG} after {LONG}", " ".join([*words[:6], "odd", *words[6:]]), " ".join([*words[:5], *words[7:]]), " ".join(words[:9]), " ".join(words[9:] + words[:9]),
             "the MIT License, (mit license) mit-license MIT licenses", "x x x", "a b a b a b a b a", "mit", "license mit"]
    for _ in range(20):
        w = list(words)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = rng.choice(["odd", "mit", "license", "x"])
        texts.append(f"{prose(rng, rng.randrange(30))} {' '.join(w)} {prose(rng, 5)}")
    return [(100 + i, t) for i, t in enumerate(texts)]


def test_scan(spark):
    rows = awkward_rows() + license_rows() + [(100, LONG), (100, "other text under the id: mit license"), (None, "mit license " * 3000)]
    got = license_scan.scan(frame(spark, rows), TEMPLATES).collect()
    want = sorted(repr((i, *brute_scan(t, TEMPLATES))) for i, t in rows)
    assert sorted(repr((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]])) for r in got) == want
    assert sum("[]" not in w for w in want) > 20


def test_summary(spark):
    rows = license_rows() + [(1, None), (2, "")]
    done = {r["doc_id"]: r for r in license_scan.summarise(license_scan.scan(frame(spark, rows), TEMPLATES), TEMPLATES).collect()}
    r = done[107]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == (3, 1, 5, "mit", "mit", 1.0)
    assert tuple(done[1])[1:] == (0, 0, None, None, "", "", 0.0) == tuple(done[2])[1:]
    assert done[100]["labels"] == "long" and done[100]["n_base"] == 0 and 0.8 <= done[104]["score"] < 1


def test_scan_of_nothing(spark):
    assert license_scan.scan(nothing(spark)).count() == 0
    none = license_scan.scan(frame(spark, [(1, "no such words"), (2, None)]))
    assert [r["spans"] for r in none.collect()] == [[], []]
    with pytest.raises(ValueError):
        license_scan.scan(nothing(spark), [license_scan.Template("x", "...")])


def test_string_ids(spark):
    df = spark.createDataFrame([("a", "mit license"), (None, "x")], "doc_id string, text string")
    assert {r["doc_id"]: len(r["spans"]) for r in license_scan.scan(df, TEMPLATES).collect()} == {"a": 1, None: 1}
