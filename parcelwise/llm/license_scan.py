"""License scan by diagonal voting: rolling word grams of the texts meet those of the templates, equal offsets vote together.

A template of n words has grams of min(n, GRAM) words at its places 0, 1, ...; a text has grams of all these lengths at all
its places. A text place minus a template place is a diagonal: a passage that follows the template votes on one diagonal,
an inserted or left-out word moves the votes after it to a neighbouring one. So the steps are

1. all rolling grams of the texts, hashed (grams whose hash no template has are dropped in the task: a join filter);
2. a join of the hashes with the templates' places, which are a bounded table of parameters and are broadcast;
3. votes added up for each text, template and diagonal, as the set of template places;
4. diagonals at most ``gap`` apart (at most GAP, and none for a template of one gram) merged into clusters, those with too few
   template places dropped;
5. the spans verified: every template word is compared with the words that the text has on the cluster's diagonals, and the
   span counts if enough template words are found. Hashes decide nothing.

Only texts with a cluster are read again and shuffled for step 5. A template of up to GRAM words has one gram, must match as
a whole and is found at every place. Step 4 has one text's diagonals of one template in a group: bounded by a text's length.

Defined results: null and empty texts have no words and no spans; ids may be null or repeated and rows may repeat, each
input row gives one result row; empty tables give none; a template without words is an error; only the named columns are
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parcelwise.llm.bitmaps import bitmap, passes
from parcelwise.llm.words import PLAIN, Words, find_words, grams, mix, slices
from parcelwise.session import reliable

GRAM, GAP = 4, 8
#: In per cent: template grams that must vote for a cluster, template words that must be found in it.
LEAST_VOTES, LEAST_WORDS = 25, 80


@dataclass(frozen=True)
class Template:
    """A text to look for; ``base`` marks the phrases whose places are counted."""

    label: str
    text: str
    base: bool = False


#: Phrases of the query's contract, then well-known notices of public licenses.
TEMPLATES = [
    Template("mit", "MIT License", True),
    Template("apache", "Apache License", True),
    Template("gpl", "General Public License", True),
    Template("cc-by-nc", "licensed under CC BY-NC"),
    Template("cc-by-sa", "licensed under CC BY-SA"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
             "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
]

SPAN = "template:int,start:bigint,stop:bigint,found:int"


def template_words(template: Template) -> list[str]:
    w = find_words(pa.array([template.text]), PLAIN, lower=True)
    if not len(w):
        raise ValueError(f"a template without words: {template}")
    return [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]


def gap_of(n_words: int) -> int:
    """How far apart diagonals of one cluster may be."""
    return min(GAP, max(0, n_words - GRAM))


def _gram_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of all k-grams that lie within one text."""
    h = mix(grams(words.hashes(), k) + np.uint64(k)) if len(words) else np.zeros(0, np.uint64)
    at = np.flatnonzero(np.arange(len(h)) + k <= np.repeat(words.first[1:], words.counts))
    return at, h[at]


def template_places(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(fp, template, place, n_words, n_grams): every gram of every template."""
    rows = []
    for i, template in enumerate(templates):
        n = len(template_words(template))
        at, fp = _gram_hashes(find_words(pa.array([template.text]), PLAIN, lower=True), min(n, GRAM))
        rows += [(int(h), i, int(p), n, len(at)) for p, h in zip(at, fp.view(np.int64))]
    return spark.createDataFrame(rows, "fp bigint, template int, place int, n_words int, n_grams int")


def _hits(docs: DataFrame, seen: Broadcast, sizes: list[int]) -> DataFrame:
    """(doc_id, text_key, n_words, hits) of every text: places and hashes of the grams that a template may have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                words = find_words(part.column(2), PLAIN, lower=True)
                rows, found = words.rows(), []
                for k in sizes:
                    at, fp = _gram_hashes(words, k)
                    likely = passes(seen.value, fp)
                    found.append((at[likely], fp[likely]))
                at, fp = np.concatenate([a for a, _ in found]), np.concatenate([f for _, f in found])
                order = np.argsort(at, kind="stable")
                at, fp = at[order], fp[order]
                pairs = pa.StructArray.from_arrays([pa.array(at - words.first[rows[at]]), pa.array(fp.view(np.int64))], names=["at", "fp"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, words.first).astype(np.int32)), pairs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.counts.astype(np.int64)), lists], names=["doc_id", "text_key", "n_words", "hits"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {id_type}, text_key bigint, n_words bigint, hits array<struct<at:bigint,fp:bigint>>")


def clusters(votes: DataFrame) -> DataFrame:
    """(doc_id, text_key, template, diagonals) of merged diagonals with enough votes, from rows of (text, template, place, diagonal)."""
    text = ["doc_id", "text_key", "template"]
    lines = votes.groupBy(*text, "n_words", "n_grams", "diagonal").agg(F.collect_set("place").alias("places"))
    order = Window.partitionBy(*text).orderBy("diagonal")
    gap = F.least(F.lit(GAP), F.greatest(F.lit(0), F.col("n_words") - GRAM))
    begins = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(True))
    numbered = lines.withColumn("begins", begins.cast("int")).withColumn("cluster", F.sum("begins").over(order))
    merged = numbered.groupBy(*text, "n_grams", "cluster").agg(
        F.sort_array(F.collect_list("diagonal")).alias("diagonals"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes")
    )
    return merged.where(100 * F.col("votes") >= LEAST_VOTES * F.col("n_grams")).select(*text, "diagonals")


def verified_span(words: list[str], template: list[str], diagonals: list[int]) -> tuple[int, int, int]:
    """(start, stop, template words found) when each template word may stand on any of the diagonals."""
    start, stop, found = len(words), 0, 0
    for t, word in enumerate(template):
        at = [t + d for d in diagonals if 0 <= t + d < len(words) and words[t + d] == word]
        if at:
            start, stop, found = min(start, at[0]), max(stop, at[-1] + 1), found + 1
    return start, stop, found


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, spans) of every text: spans are (template number, start, stop, words found), in order of start."""
    spark = docs.sparkSession
    places = template_places(spark, templates)
    vocabulary = [template_words(t) for t in templates]
    sizes = sorted({min(len(w), GRAM) for w in vocabulary})
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = reliable(_hits(rows, bitmap(places, "fp", sum(map(len, vocabulary))), sizes))
    places = places.withColumnRenamed("n_words", "length")
    met = read.where(F.size("hits") > 0).select("doc_id", "text_key", F.inline("hits")).join(F.broadcast(places), "fp")
    votes = met.select("doc_id", "text_key", "template", "place", F.col("length").alias("n_words"), "n_grams", (F.col("at") - F.col("place")).alias("diagonal"))
    found = reliable(clusters(votes).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("template", "diagonals")).alias("clusters")))
    wanted = bitmap(found, "text_key", found.count())

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted.value, batch.column(1).to_numpy().view(np.uint64))))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                w = find_words(part.column(2), PLAIN, lower=True)
                data, out = w.data.tobytes(), []
                for r, listed in enumerate(part.column(3).to_pylist()):
                    words = [data[a:b].decode() for a, b in zip(w.start[w.first[r] : w.first[r + 1]], w.end[w.first[r] : w.first[r + 1]])]
                    spans = []
                    for cluster in listed:
                        template = vocabulary[cluster["template"]]
                        start, stop, n = verified_span(words, template, cluster["diagonals"])
                        if 100 * n >= (LEAST_WORDS if len(template) > GRAM else 100) * len(template):
                            spans.append({"template": cluster["template"], "start": start, "stop": stop, "found": n})
                    out.append(sorted(spans, key=lambda s: (s["start"], s["stop"], s["template"])))
                spans = pa.array(out, pa.list_(pa.struct([("template", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("found", pa.int32())])))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), spans], names=["doc_id", "text_key", "spans"])

    texts = rows.select("doc_id", "text_key", "text").mapInArrow(again, f"doc_id {id_type}, text_key bigint, text string")
    listed = found.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "clusters")
    same = texts["doc_id"].eqNullSafe(listed["id"]) & (texts["text_key"] == listed["key"])
    verified = texts.join(listed, same).select("doc_id", "text_key", "text", "clusters").mapInArrow(verify, f"doc_id {id_type}, text_key bigint, spans array<struct<{SPAN}>>")
    spans = verified.where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "spans")
    same = read["doc_id"].eqNullSafe(spans["id"]) & (read["text_key"] == spans["key"])
    return read.select("doc_id", "text_key", "n_words").join(spans, same, "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("spans", F.array().cast(f"array<struct<{SPAN}>>")).alias("spans")
    )


def summarise(scanned: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """One row a text: places of base phrases and their ends, labels, and the best share of a template's words as score."""
    base = [i for i, t in enumerate(templates) if t.base]
    label = F.create_map(*[F.lit(x) for i, t in enumerate(templates) for x in (i, t.label)])
    lengths = F.create_map(*[F.lit(x) for i, t in enumerate(templates) for x in (i, len(template_words(t)))])
    phrases = F.filter("spans", lambda s: s["template"].isin(base))

    def named(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: F.element_at(label, s["template"])))), ",")

    starts = F.transform(phrases, lambda s: s["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(phrases).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        named(phrases).alias("base_labels"), named(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["found"] / F.element_at(lengths, s["template"]))), F.lit(0.0)).alias("score"),
    )
