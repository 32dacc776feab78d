"""Operators over whole tables, against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelwise.llm import components, context_trees, curve_packing, kd_shards, ngram_join, super_kmers, winnowing
from tests.llm.cases import PLAIN, SPACED, awkward_rows, frame, lower, nothing, prose


def brute_hits(text, items):
    w = PLAIN.findall(lower(text or ""))
    hit, found = set(), set()
    for item, body in items:
        v = PLAIN.findall(lower(body or ""))
        if item is None or not v:
            continue
        k = min(10, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("with_five", [False, True])
def test_winnowing(spark, with_five):
    rng = random.Random(8)
    rows = awkward_rows() + [(50 + i, prose(rng, rng.randrange(60), 4)) for i in range(40)]
    items = [(i, prose(rng, n, 4)) for i, n in enumerate((10, 11, 14, 25, 1, 2, 3, 9, 6))] + [(20, None), (21, ""), (None, "w1 w1"), (22, rows[0][1]), (23, "one two three"), (9, prose(rng, 12, 4))]
    items += [(30, prose(rng, 5, 4)), (31, "the the the the the")] if with_five else []
    items += [(40 + i, " ".join(t.split()[20:45])) for i, t in enumerate(t for _, t in rows if t and len(t.split()) > 60)]
    got = winnowing.decontaminate(frame(spark, rows), frame(spark, items, "item_id").withColumn("item_id", F.col("item_id"))).collect()
    assert sorted(map(repr, ((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got))) == sorted(map(repr, ((i, *brute_hits(t, items)) for i, t in rows)))
    none = winnowing.decontaminate(frame(spark, rows), nothing(spark, "item_id"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(rows)
    assert winnowing.decontaminate(nothing(spark), frame(spark, items, "item_id")).count() == 0


def brute_groups(rows, n=5, percent=80):
    sets = []
    for _, t in rows:
        w = SPACED.findall(lower(t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    of = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and of[a] != of[b]:
            of = [of[a] if x == of[b] else x for x in of]
    least = defaultdict(list)
    for (i, _), c in zip(rows, of):
        if i is not None:
            least[c].append(i)
    return sorted(repr((i, len(s), min(least[c]) if least[c] and s else i)) for (i, _), s, c in zip(rows, sets, of))


def near_copies(seed):
    """Texts that differ in a few words from others, in chains, around the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        words = prose(rng, rng.randrange(8, 90), 4000).split()
        for _ in range(rng.randrange(1, 9)):
            rows.append((rng.randrange(10**6), " ".join(words)))
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    common = prose(rng, 40, 4000)
    rows += [(rng.randrange(10**6), f"{prose(rng, rng.randrange(60), 4000)} {common}") for _ in range(15)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    rows = near_copies(seed) + (awkward_rows() if seed == 1 else [])
    got = ngram_join.jaccard_groups(frame(spark, rows)).collect()
    assert sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == brute_groups(rows)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.jaccard_groups(nothing(spark)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(400, 400)]
    of = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((of[a], of[b]))
        of = {k: low if v == high else v for k, v in of.items()}
    least = defaultdict(lambda: 10**9)
    for k, v in of.items():
        least[v] = min(least[v], k)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: least[v] for k, v in of.items()}


def brute_repeats(rows, span):
    starts = defaultdict(set)
    words = [SPACED.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        if i is not None:
            for j in range(len(w) - span + 1):
                starts[tuple(w[j : j + span])].add(i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = {j + k for j in range(len(w) - span + 1) if i is not None and min(starts[tuple(w[j : j + span])]) < i for k in range(span)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append(repr((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())))
    return sorted(out)


@pytest.mark.parametrize(("span", "least_heavy"), [(50, 256), (50, 1), (4, 256), (4, 3), (12, 1)])
def test_super_kmers(spark, span, least_heavy, monkeypatch):
    rng = random.Random(span)
    rows = awkward_rows() + [(100 + i, prose(rng, 60, 3)) for i in range(12)]
    got = super_kmers.remove_repeats(frame(spark, rows), span, least_heavy=least_heavy).collect()
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in got) == brute_repeats(rows, span)


def test_super_kmers_in_small_portions():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 400)
    rank = super_kmers.window_ranks(codes, 7)
    same = defaultdict(set)
    for i in range(394):
        same[tuple(codes[i : i + 7])].add(rank[i])
    assert all(len(x) == 1 for x in same.values()) and len({next(iter(x)) for x in same.values()}) == len(same)


def test_cut_repeats_keeps_columns_and_white_space(spark):
    rng = random.Random(6)
    passage = "\n".join(prose(rng, 30, 5000) for _ in range(2))
    rows = [(1, f"first\n{passage}"), (2, f"own  words\t{passage}\n and more"), (3, passage), (4, None), (5, "")]
    df = frame(spark, rows)
    got = super_kmers.cut_repeats(df)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: rows[0][1], 2: "own  words\tand more", 4: None, 5: ""}
    assert super_kmers.cut_repeats(nothing(spark)).count() == super_kmers.remove_repeats(nothing(spark)).count() == 0


@pytest.mark.parametrize(("rows_a_batch", "portion"), [(7, 300), (3, 2000), (50, 120)])
def test_super_kmer_buckets_across_batches(spark, rows_a_batch, portion):
    rng = random.Random(9)
    rows = [(i, f"{prose(rng, 30, 9000)} {' '.join(f'p{j}' for j in range(70))} {prose(rng, 30, 9000)}") for i in range(60)]
    rows += [(100 + i, prose(random.Random(i // 3), 200, 9000)) for i in range(30)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows_a_batch))
    try:
        got = super_kmers.remove_repeats(frame(spark, rows), portion=portion).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in got) == brute_repeats(rows, 50)


def test_kd_shards(spark):
    rng = random.Random(7)
    rows = [(i, "hot text " * 9 if rng.random() < 0.4 else prose(rng, rng.randrange(120))) for i in range(3000)]
    docs = frame(spark, rows, clash=False).withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    def dims(df):
        return {"source": kd_shards.text_number(df["source"]), "length": F.log2(1 + F.octet_length("text"))}

    for shards in (16, 5, 1):
        got = kd_shards.with_slots(kd_shards.kd_shards(kd_shards.narrow_rows(docs, dims(docs)), shards)).toPandas()
        assert sorted(got["doc_id"]) == list(range(3000)) and set(got["shard"]) == set(range(shards))
        by = got.groupby("shard")
        assert (by["size"].sum() - got["size"].sum() / shards).abs().max() <= 0.01 * got["size"].sum() / shards + 2 * got["size"].max()
        assert all(sorted(s) == list(range(len(s))) for _, s in by["slot"])
    text = dict(rows)
    assert all(r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got[["doc_id", "size", "text_crc32"]].itertuples())


def test_kd_shards_of_awkward_rows(spark):
    rows = awkward_rows()
    for docs, n in ((frame(spark, rows), len(rows)), (nothing(spark), 0)):
        placed = kd_shards.with_slots(kd_shards.kd_shards(kd_shards.narrow_rows(docs, {"length": F.octet_length("text")}), 4)).collect()
        assert len(placed) == n and all(0 <= r["shard"] < 4 for r in placed)


def brute_shards(rows, first, leaves, shard_of):
    """The tree by sorting: rows are (places, bytes, number)."""
    if not rows:
        return
    if leaves == 1:
        shard_of.update((n, first) for _, _, n in rows)
        return
    axis = max(range(len(rows[0][0])), key=lambda i: (max(p[i] for p, _, _ in rows) - min(p[i] for p, _, _ in rows), -i))
    half, below, sums = leaves // 2, 0, defaultdict(int)
    for p, size, _ in rows:
        sums[p[axis]] += size
    want = sum(sums.values()) * half / leaves
    for place in sorted(sums):
        if below + sums[place] >= want:
            break
        below += sums[place]
    cut = place if want - below < below + sums[place] - want and below > 0 else place + 1
    brute_shards([r for r in rows if r[0][axis] < cut], first, half, shard_of)
    brute_shards([r for r in rows if r[0][axis] >= cut], first + half, leaves - half, shard_of)


@pytest.mark.parametrize("shards", [16, 5])
def test_kd_shards_equal_the_tree_by_sorting(spark, shards):
    rng = random.Random(shards)
    copies = [prose(rng, 40, 900) for _ in range(30)]
    texts = [rng.choice(copies) if rng.random() < 0.3 else "hot text " * 9 if rng.random() < 0.3 else prose(rng, rng.randrange(100), 900) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t, f"a shared beginning {rng.randrange(9) // 3}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    narrow = kd_shards.narrow_rows(docs, {"source": kd_shards.text_number("source"), "length": F.log2(1 + F.octet_length("text"))}, whole=1 / (4 * shards))
    rows = [((r["d0"], r["d1"]), r["size"], r["doc_id"]) for r in narrow.collect()]
    want = {}
    brute_shards(rows, 0, shards, want)
    got = {r["doc_id"]: r["shard"] for r in kd_shards.kd_shards(narrow, shards, tolerance=0).collect()}
    assert got == want
    places = defaultdict(set)
    for i, t in enumerate(texts):
        places[t].add(got[i])
    total = sum(len(t.encode()) + 1 for t in texts)
    for t, found in places.items():
        assert len(found) == 1 or texts.count(t) * (len(t.encode()) + 1) > total / (4 * shards)
    held = Counter()
    for i, t in enumerate(texts):
        held[got[i]] += len(t.encode()) + 1
    assert set(held) == set(range(shards)) and all(abs(n - total / shards) <= total / (4 * shards) for n in held.values())


def test_sources_with_one_beginning_are_told_apart(spark):
    df = spark.createDataFrame([("https://a",), ("https://b",), ("https://a",), (None,)], "source string")
    a, b, again, none = (r[0] for r in df.select(kd_shards.text_number("source")).collect())
    assert a == again != b and none is None


def test_slots_of_a_row_that_is_repeated(spark):
    rows = [(None, "one text")] * 5003 + [(i, f"text {i}") for i in range(50)]
    got = kd_shards.with_slots(kd_shards.kd_shards(kd_shards.narrow_rows(frame(spark, rows), {"length": F.octet_length("text")}), 3)).collect()
    assert len(got) == len(rows)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_super_kmers_of_named_documents(spark):
    """Ids that are not whole numbers go by their own order."""
    rng = random.Random(3)
    passage = prose(rng, 70, 5000)
    rows = [("b", f"x {passage}"), ("a10", passage), ("a9", f"{passage} y"), (None, passage), ("a10", passage)]
    got = super_kmers.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r["doc_id"] or "", r["n_removed"]) for r in got) == [("", 0), ("a10", 0), ("a10", 0), ("a9", 70), ("b", 70)]
    kept = super_kmers.cut_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted(((r["doc_id"] or "", r["text"]) for r in kept)) == sorted([("", passage), ("a10", passage), ("a10", passage), ("a9", "y"), ("b", "x ")])


def test_hilbert_neighbours():
    side = range(8)
    points = np.array(list(itertools.product(side, side, side)))
    key = curve_packing.hilbert_key(points, 3)
    assert sorted(key) == list(range(512))
    path = points[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_round_trip(spark):
    rows = [(i, t) for i, (_, t) in enumerate(awkward_rows())] + [(90, "<|startoftext|> Ünïcode\u0301 e\u0301\u2003x İI ΣΑΣ don't 12ab"), (91, "e \u0301x")]
    path = public_tokenizers.path("word_bpe_49k.json")
    got = curve_packing.pack(frame(spark, rows), path, length=64, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    pieces, sequences = defaultdict(dict), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]][r["start"]] = r["ids"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in rows:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert [x for s in sorted(pieces[i]) for x in pieces[i][s]] == want
    for s in sequences.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(s))]
        assert [o for o, _ in sorted(s)] == ends[:-1] and ends[-1] <= 64 and ends[-1] & (ends[-1] - 1) == 0
    assert curve_packing.pack(nothing(spark), path).count() == 0


def test_new_pieces_are_encoded_some_at_a_time():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, given = curve_packing.WordEncoder(path), []
    tokenizer = encoder.tokenizer

    class Recorder:
        def encode_batch_fast(self, texts, **how):
            given.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **how)

    encoder.tokenizer = Recorder()
    texts = [" ".join(f"q{i}z{j}" for j in range(200)) for i in range(100)]
    ids, first = encoder.encode(pa.array(texts), 2)
    assert sum(given) >= 20_000 and max(given) <= 8192
    for text, a, b in zip(texts, first[:-1], first[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_new_words_are_joined_and_kept():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, given = curve_packing.WordEncoder(path), []
    tokenizer = encoder.tokenizer

    class Recorder:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    encoder.tokenizer = Recorder()
    letters = "abcdefghijklmnopqrstuvwxyzéß"
    words = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=4), 260_000)]
    texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
    for at in range(0, len(texts), 100):
        ids, first = encoder.encode(pa.array(texts[at : at + 100]), 2)
    assert ids[first[-2] :].tolist() == [*tokenizer.encode(texts[-1], add_special_tokens=False).ids, 2]
    assert len(given) <= len(words) / 200  # hundreds of words a call
    given.clear()
    ids, first = encoder.encode(pa.array(texts[:5]), 2)
    assert not given  # none was forgotten
    assert ids[: first[1]].tolist() == [*tokenizer.encode(texts[0], add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("kept, hash_bits", [(1 << 19, 64), (40, 64), (1 << 19, 3), (40, 3)])
def test_ids_of_odd_words(monkeypatch, kept, hash_bits):
    rng, path = random.Random(5), public_tokenizers.path("word_bpe_49k.json")
    encoder = curve_packing.WordEncoder(path)
    hashes = curve_packing.Words.hashes
    monkeypatch.setattr(curve_packing, "CACHED_WORDS", kept)
    monkeypatch.setattr(curve_packing.Words, "hashes", lambda self: hashes(self) >> np.uint64(64 - hash_bits))
    signs = [*"aAzZqQ", *map(chr, range(0xA0, 0x100)), "\u0130", "\u0301", "\u0149", "\u01c5", "\u2003", "\u00d7", "\u03a3", "\u4e2d", "\u2026", "'", ".", "-", "7", "don't", "I'LL", "<|endoftext|>"]
    texts = ["".join(rng.choice([*signs, " ", "\n"]) for _ in range(rng.randrange(30))) for _ in range(600)] + ["", " ", "\u2003", "caf\u00e9 na\u00efve STRASSE stra\u00dfe"]
    for _ in range(2):
        for at in range(0, len(texts), 60):
            part = texts[at : at + 60]
            ids, first = encoder.encode(pa.array(part), 2)
            assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in part]


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 8, 100.5, 1e9])
    assert np.allclose(context_trees._lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-10)


def _entries(text: bytes, depth: int, least: int):
    padded = bytes([10] * depth) + text
    out = []
    for d in range(depth + 1):
        seen = Counter((padded[i - d : i], padded[i]) for i in range(depth, len(padded)))
        total = Counter()
        for (c, _), n in seen.items():
            total[c] += n
        rows = sorted((int.from_bytes(c, "big") << 8 | b, n) for (c, b), n in seen.items() if total[c] >= least)
        out.append((np.array([k for k, _ in rows], np.uint64), np.array([n for _, n in rows], np.int64)))
    return out


def _weighted(entries, depth, context, node, bit):
    """(log Pe, log Pw, counts) of one node by the definition, its kept children and the rest."""
    def counts(d, ctx):
        zero = one = 0
        for k, n in zip(*entries[d]):
            k = int(k)
            if k >> 8 == ctx and (k & 255) >> (8 - bit) | 1 << bit == node:
                if (k & 255) >> (7 - bit) & 1:
                    one += int(n)
                else:
                    zero += int(n)
        return zero, one

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def walk(d, ctx):
        a, b = counts(d, ctx)
        own = kt(a, b)
        if d == depth:
            return own, own, (a, b), own
        children = {int(k) >> 8 for k in entries[d + 1][0] if int(k) >> 8 & ((1 << 8 * d) - 1) == ctx}
        parts = [walk(d + 1, c) for c in sorted(children)]
        rest = a - sum(p[2][0] for p in parts), b - sum(p[2][1] for p in parts)
        split = sum(p[1] for p in parts) + kt(*rest)
        return own, math.log(0.5) + np.logaddexp(own, split), (a, b), split

    return walk(0, 0)


@pytest.mark.parametrize("least", [1, 4])
def test_context_trees(least, monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"aabbc \n") for _ in range(300))
    depth = 2
    entries = _entries(text, depth, least)
    trees = context_trees.build(entries)
    # the root's own and split weights, by the definition
    for bit, node in ((0, 1), (1, 2), (7, 0x61 >> 1 | 0x80)):
        own, weighted, _, split = _weighted(entries, depth, b"", node, bit)
        level = trees.levels[0][bit]
        at = int(np.searchsorted(level.key, node))
        assert math.isclose(level.stop[at], math.exp(own - np.logaddexp(own, split)), rel_tol=1e-9)
    # probabilities after any context, seen or not, sum to one
    for context in (b"ab", b"\n\n", b"zz", b"cz"):
        keys = np.array([int.from_bytes(context, "big") << 8 | b for b in range(256)], np.uint64)
        assert math.isclose((10 ** trees.log10(keys)).sum(), 1.0, rel_tol=1e-9)


def test_keys_are_looked_up_in_order(monkeypatch):
    rng = np.random.default_rng(4)
    known = np.unique(np.concatenate((rng.integers(0, 1 << 48, 30_000), [0, (1 << 48) - 1]))).astype(np.uint64)
    value, search, in_order = rng.random(len(known)), np.searchsorted, []

    def watched(table, keys, *how, **more):
        in_order.append(bool((keys[1:] >= keys[:-1]).all()))
        return search(table, keys, *how, **more)

    monkeypatch.setattr(np, "searchsorted", watched)
    for n in (0, 1, 65_536, 150_001):
        key = known[rng.integers(0, len(known), n)]
        assert (context_trees._found(known, value, key) == value[search(known, key)]).all()
    assert in_order and all(in_order)
    assert (context_trees._distinct(known[[5, 3, 5, 9, 3]]) == known[[3, 5, 9]]).all() and not len(context_trees._distinct(known[:0]))


def test_scores_of_awkward_rows(spark):
    rows = awkward_rows()
    train = lambda i: i is not None and i % 3 != 2
    got = context_trees.score_texts(frame(spark, rows), F.col("doc_id") % 3 != 2).collect()
    tokens = [SPACED.findall(lower(t or "")) + [None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, tokens) if train(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = {(i, t): (len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for (i, t), w in zip(rows, tokens)}
    expected = sorted((-1 if i is None else i, a, b, round(s, 6)) for (i, t) in rows for a, b, s in [want[i, t]])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in got)
    alone = context_trees.score_texts(frame(spark, rows).where("doc_id = 12"), F.lit(False)).first()
    bits = sum(len(w.encode()) + 1 for w in SPACED.findall(dict(rows)[12])) * 8
    assert math.isclose(alone["score"], bits * math.log10(0.5), rel_tol=1e-9) and alone["n_known"] == 0
    assert context_trees.score_texts(nothing(spark), F.lit(True)).count() == 0


def test_scores_do_not_depend_on_neighbours(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    together = {(r["doc_id"], r["n_tokens"]): r["score"] for r in context_trees.score_texts(frame(spark, rows), F.lit(True)).collect()}
    one = context_trees.score_texts(frame(spark, rows).repartition(1).orderBy("doc_id"), F.lit(True)).collect()
    assert all(math.isclose(together[r["doc_id"], r["n_tokens"]], r["score"], rel_tol=1e-9) for r in one)


def test_buckets_of_rare_words_hold_only_documents_with_them(spark):
    class Hot:
        value = (np.sort(context_trees.find_words(pa.array(["the of"])).hashes()), np.zeros(2))

    rows = [(i, "the of the" if i % 50 else f"the rare{i} of") for i in range(200)] + [(7, "the of the"), (None, None)]
    df = frame(spark, rows, clash=False).select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(True).alias("train"), "text")
    dealt = context_trees._deal_rare(df, Hot, 1)
    assert sorted(i for r in dealt.collect() for i in r["doc_ids"]) == [0, 50, 100, 150]
    got = {r["doc_id"]: r for r in context_trees._rare_sums(df, Hot, 1).collect()}
    assert len(got) == 201 and got[7]["rows"] == 2 and sum(r["rows"] for r in got.values()) == 202
    assert {i for i, r in got.items() if r["known"]} == {0, 50, 100, 150}


def test_context_seen_twice_is_a_node_at_any_size(spark):
    """Slices, buckets and subtrees give the scores of one tree over all training bytes, also beside a megabyte of other text."""
    rows = [*awkward_rows(), (100, "ab " * 400_000)]
    streams = [" ".join(SPACED.findall(lower(t or ""))).encode() + b"\n" for _, t in rows]
    depth, entries = context_trees.DEPTH, []
    padded = [b"\n" * depth + x for x in streams]
    for d in range(depth + 1):
        seen = Counter(p[i - d : i + 1] for (k, _), p in zip(rows, padded) if k is not None and k % 3 != 2 for i in range(depth, len(p)))
        total = Counter()
        for x, n in seen.items():
            total[x[:-1]] += n
        kept = sorted((int.from_bytes(x, "big"), n) for x, n in seen.items() if total[x[:-1]] >= 2)
        entries.append((np.array([k for k, _ in kept], np.uint64), np.array([n for _, n in kept], np.int64)))
    whole = context_trees.build(entries)
    want = []
    for (i, _), p in zip(rows, padded):
        each = Counter(p[j - depth : j + 1] for j in range(depth, len(p)))
        logs = whole.log10(np.array([int.from_bytes(x, "big") for x in each], np.uint64))
        want.append((-1 if i is None else i, float(logs @ np.array(list(each.values())))))
    got = context_trees.score_texts(frame(spark, rows), F.col("doc_id") % 3 != 2).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in got)
    assert [i for i, _ in got] == [i for i, _ in sorted(want)]
    assert np.allclose([x for _, x in got], [x for _, x in sorted(want)], rtol=1e-6)
