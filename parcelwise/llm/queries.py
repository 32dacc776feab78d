"""One registered query for each operator, over its whole table, and SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwise.llm import compression_quality, context_trees, curve_packing, divergence, kd_shards, language_spans, license_scan, line_rules, ngram_join, super_kmers, url_filters, whitening, winnowing

#: Fixed values of the query's contract.
URL_RULES = [
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "example.org", "/es/"),
    url_filters.Rule("block", "example.org", "/en/1"),
    url_filters.Rule("allow", "com", "/fr/"),
    url_filters.Rule("block", "com", "/de/"),
]
#: Host names of sites that carry no text worth keeping.
BLOCKED_SITES = ["*adult*/**", "*casino*/**", "*free-bets*/**", "*spam-farm*/**", "*cheap-pills*/**", "*ads-track*/**"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_kd_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = kd_shards.narrow_rows(docs, {
        "source": kd_shards.text_number(F.col("source")), "lang": kd_shards.text_number(F.col("lang")), "length": F.log2(1 + F.octet_length("text")),
    }, whole=1 / (16 * shards))
    placed = kd_shards.with_slots(kd_shards.kd_shards(rows, shards))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.filter_urls(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_SITES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
dw AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
met AS (SELECT r, i, k, item_id FROM dw JOIN iw USING (k, win)),
hit AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT r, i, k FROM met), range(10) t(j) WHERE j < k GROUP BY r),
its AS (SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_rules.clean_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP2_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
win AS (
  SELECT r, i, string_agg(word, ' ') OVER e AS win, count(*) OVER e AS n
  FROM words WINDOW e AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win WHERE n = 8),
covered AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(8) t(j) WHERE c > 1 GROUP BY r),
raw AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM docs),
lines AS (
  SELECT r, line, k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, len(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS differing,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS earlier
  FROM raw),
judged AS (
  SELECT r, words, line, earlier, symbols >= 0.25 * words
    OR len(regexp_extract_all(line, '!!')) >= 0.25 * words OR (words >= 3 AND line <> lower(line) AND line = upper(line))
    OR (words >= 16 AND differing <= 0.4 * words)
    OR (words < 5 AND NOT regexp_matches(line, '[.!?…]["'')\]»”]*[\x20\x09-\x0D]*$'))
    OR (words >= 5 AND NOT regexp_matches(line, '[.,;:!?…。।]'))
    OR earlier OR (words < 20 AND regexp_matches(lower(line),
      'all rights reserved|cookie policy|privacy policy|terms of use|terms of service|click here|read more|sign up|log in')) AS failed
  FROM lines WHERE words > 0),
by_doc AS (SELECT r, sum(words) FILTER (NOT failed) AS stays, count(*) - count(DISTINCT line) AS n_dup_lines FROM judged GROUP BY r),
base AS (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(stays, 0) AS stays
  FROM split LEFT JOIN covered USING (r) LEFT JOIN by_doc USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND stays >= 0.5 * n_words AS kept
FROM base
"""

OP4_SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict,
  CASE WHEN path <> '' AND regexp_matches(parts.host, 'adult|casino|free-bets|spam-farm|cheap-pills|ads-track') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""

def id_remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def op5_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_trees.score_texts(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) != 2)
    return scored.withColumn("held_out", id_remainder("doc_id", 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"), where=id_remainder("id", 5) != 0)
    scored = compression_quality.score(docs, model)
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM sh a JOIN sh b USING (s) WHERE a.r <> b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM pairs JOIN size x ON a = x.r JOIN size y ON b = y.r WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach(r, t) AS (SELECT r, r FROM docs UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.t = links.a),
least AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.t GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs LEFT JOIN size USING (r) LEFT JOIN least USING (r)
"""


def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_spans.fit(docs, where=id_remainder("id", 4) != 2)
    labelled = language_spans.label_spans(docs, model)
    return labelled.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_kmers.remove_repeats(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
again AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY h) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT r, i + j AS i FROM again, range(50) t(j)),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (r)
"""

def op11_run_length_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
cells AS (SELECT lang, source, term, count(*) AS c FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
by_lang AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
by_group AS (SELECT lang, source, sum(c) AS n FROM cells GROUP BY lang, source),
grp AS (
  SELECT lang, source, coalesce(g.n, 0) AS n, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN by_group g USING (lang, source) LEFT JOIN by_lang l USING (lang)),
p AS (
  SELECT lang, grp.source, term, coalesce(c, 0) AS c, CAST(1 + (1000000000 * (CAST(coalesce(c, 0) AS HUGEINT) + 2)) // (n + 2 * v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (CAST(total AS HUGEINT) + 2)) // (lang_n + 2 * v) AS BIGINT) AS q
  FROM grp JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (
  SELECT lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b USING (lang) LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source WHERE a.source <> b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q), row_number() OVER (PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // (p + q) DESC, term)
  FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op12_secular_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model).select("vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(float(e) / model.trace if model.trace else None) for e in model.eigenvalues]).cast("array<double>")
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def op13_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summarise(license_scan.scan(table(spark, sf_dir, "documents")))


def _template_rows() -> str:
    return ", ".join(
        f"({i}, '{t.label}', {str(t.base).lower()}, ['{"', '".join(license_scan.template_words(t))}'])" for i, t in enumerate(license_scan.TEMPLATES)
    )


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
tpl(t, label, base, tw) AS (VALUES TEMPLATE_ROWS),
tg AS (
  SELECT t, len(tw) AS n, least(len(tw), 4) AS k, place, array_to_string(tw[place + 1:place + least(len(tw), 4)], ' ') AS gram
  FROM (SELECT t, tw, unnest(range(0, len(tw) - least(len(tw), 4) + 1)) AS place FROM tpl)),
dg AS (
  SELECT r, k, i, array_to_string(w[i + 1:i + k], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM docs, (SELECT DISTINCT k FROM tg) WHERE len(w) >= k)),
votes AS (SELECT DISTINCT r, t, n, k, place, i - place AS diagonal FROM dg JOIN tg USING (k, gram)),
lines AS (
  SELECT r, t, n, k, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) <= least(8, greatest(0, n - 4)) THEN 0 ELSE 1 END AS begins
  FROM (SELECT DISTINCT r, t, n, k, diagonal FROM votes)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY r, t ORDER BY diagonal) AS cluster FROM lines),
heard AS (
  SELECT r, t, cluster FROM numbered JOIN votes USING (r, t, n, k, diagonal)
  GROUP BY r, t, cluster, n, k HAVING 100 * count(DISTINCT place) >= 25 * (n - k + 1)),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs WHERE r IN (SELECT r FROM heard)),
tword AS (SELECT t, unnest(tw) AS word, generate_subscripts(tw, 1) - 1 AS place FROM tpl),
spans AS (
  SELECT r, t, cluster, n, min(i) AS start, count(DISTINCT place) AS found
  FROM heard JOIN numbered USING (r, t, cluster) JOIN tword USING (t) JOIN word USING (r, word) WHERE i = place + diagonal
  GROUP BY r, t, cluster, n HAVING 100 * count(DISTINCT place) >= CASE WHEN n > 4 THEN 80 ELSE 100 END * n),
by_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(found / n) AS score
  FROM spans JOIN tpl USING (t) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score
FROM docs LEFT JOIN by_doc USING (r)
""".replace("TEMPLATE_ROWS", _template_rows())

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_winnowing": op1_winnowing, "op2_line_rules": op2_line_rules, "op3_kd_shards": op3_kd_shards, "op4_url_filters": op4_url_filters, "op5_context_trees": op5_context_trees, "op6_curve_packing": op6_curve_packing, "op7_compression_quality": op7_compression_quality, "op8_ngram_join": op8_ngram_join, "op9_language_spans": op9_language_spans, "op10_super_kmers": op10_super_kmers, "op11_run_length_divergence": op11_run_length_divergence, "op12_secular_whitening": op12_secular_whitening, "op13_diagonal_licenses": op13_diagonal_licenses}
SQL: dict[str, str] = {"op1_winnowing": OP1_SQL, "op2_line_rules": OP2_SQL, "op4_url_filters": OP4_SQL, "op8_ngram_join": OP8_SQL, "op10_super_kmers": OP10_SQL, "op11_run_length_divergence": OP11_SQL, "op13_diagonal_licenses": OP13_SQL}
