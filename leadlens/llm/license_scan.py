"""License scan (operator 4), DataFrame functions only.

Base labels come from exact phrases in the document's word sequence.  The
method's labels come from an exact set-similarity join between the text
blocks of all documents and license notice templates: a block matches a
template when it contains at least ``THRESHOLD`` of the template's distinct
words.  Blocks are the lines of up to twice the longest template's words and,
for notices wrapped over several lines or inside longer ones, word windows of
that length over the whole text, one every half a window, so every stretch of
half a window lies in one; words scattered more widely are no notice.  Template words are ordered by their document
frequency over the whole corpus, rarest first.  A block that meets the
threshold must hold one of a template's first |T| - need + 1 words (prefix
filter), have ``need`` distinct words (length filter), and have enough
words left behind the shared one on both sides (positional filter); what
passes is verified.

The template list is fixed, so everything derived from it (words, their
frequencies, the postings) is bounded by it and not by the data.

Defined cases: null text counts as empty (no words, no labels, score 0);
rows with equal doc_id and text are labelled alike; an empty table gives an
empty table; other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialise

# Phrases of the contract and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Public license notices, one sentence each.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                 "with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
            "rights to this work"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced or transmitted in "
                            "any form without prior written permission"),
]
THRESHOLD = 0.8
# What separates words once A-Z count as word characters.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def _lower(w: Column) -> Column:
    return F.transform(w, lambda x: F.lower(x))


def _starts(w: Column, phrase: str) -> Column:
    """Start indexes of a phrase in an array of lower-case words."""
    parts = phrase.split()

    def here(i):
        hit = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(w, i + k) == p, F.lit(False))
        return hit

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - len(parts), F.lit(0))), here)


def _all_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _template_words(text: str) -> list[str]:
    out: list[str] = []
    for x in _all_words(text):
        if x not in out:
            out.append(x)
    return out


def longest(templates) -> int:
    """Words of the longest template."""
    return max(len(_all_words(t)) for _, t in templates)


def phrase_hits(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_base, first_word, last_word, base_list."""
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    maybe = "(?i)" + "|".join(gap.join(p.split()) for p, _ in PHRASES)
    df = (docs.select("doc_id", F.col("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
          .withColumn("_w", license_words(F.col("text")))
          .withColumn("_lw", F.when(F.coalesce("text", F.lit("")).rlike(maybe), _lower(F.col("_w")))))
    df = df.withColumn("_at", F.array(*[
        F.when(F.col("_lw").isNotNull(), _starts(F.col("_lw"), p)).otherwise(F.array().cast("array<int>"))
        for p, _ in PHRASES]))
    flat = F.flatten("_at")
    labels = F.array_compact(F.array(*[F.when(F.size(F.get("_at", F.lit(k))) > 0, F.lit(label))
                                       for k, (_, label) in enumerate(PHRASES)]))
    return df.select("doc_id", "text_key", F.size("_w").cast("long").alias("n_words"),
                     F.size(flat).cast("long").alias("n_base"),
                     F.array_min(flat).cast("long").alias("first_word"),
                     F.array_max(flat).cast("long").alias("last_word"), labels.alias("base_list"))


def _postings(docs: DataFrame, templates, threshold: float):
    """Template words with corpus document frequencies, rarest first."""
    sets = [(label, _template_words(t)) for label, t in templates]
    vocab = sorted({x for _, ws in sets for x in ws})
    seen = F.array_intersect(_lower(license_words(F.col("text"))), F.array(*[F.lit(x) for x in vocab]))
    # at most one row per template word: bounded by the template list
    df = {r["x"]: r["n"] for r in docs.select(F.explode(seen).alias("x")).groupBy("x").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocab, key=lambda x: (df.get(x, 0), x))
    rank = {x: k for k, x in enumerate(order)}
    out = []
    for t, (label, ws) in enumerate(sets):
        ws = sorted(ws, key=rank.get)
        need = math.ceil(threshold * len(ws) - 1e-9)
        out.append((t, label, ws, need))
    return order, out


def block_matches(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """Every (doc_id, text_key, line_no, label, containment) that meets the
    threshold; line_no is -1 less the first word for a window."""
    order, sets = _postings(docs, templates or TEMPLATES, threshold)
    spark = docs.sparkSession
    ranked = F.array(*[F.lit(x) for x in order])
    prefix = sorted({x for _, _, ws, need in sets for x in ws[:len(ws) - need + 1]})
    table = spark.createDataFrame(
        [(x, t, label, i, len(ws), need, ws) for t, label, ws, need in sets
         for i, x in enumerate(ws[:len(ws) - need + 1])],
        "x string, t int, label string, i int, size int, need int, ws array<string>")
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    span = longest(templates or TEMPLATES)
    lines = docs.select("doc_id", key, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line")) \
        .select("doc_id", "text_key", "line_no", license_words(F.col("line")).alias("w")).where(F.size("w") <= 2 * span)
    # a text of one short line is the only window of itself
    wrapped = (docs.select("doc_id", key, F.col("text").contains("\n").alias("many"), license_words(F.col("text")).alias("w"))
               .where(F.col("many") | (F.size("w") > 2 * span))
               .select("doc_id", "text_key", F.explode(F.transform(
                   F.sequence(F.lit(0), F.greatest(F.size("w") - span - 1, F.lit(0)), F.lit(span)),
                   lambda i: F.struct((-1 - i).alias("line_no"), F.slice("w", i + 1, 2 * span).alias("w")))).alias("x"))
               .select("doc_id", "text_key", "x.line_no", "x.w"))
    least = min(need for *_, need in sets)
    blocks = (lines.unionByName(wrapped).withColumn("b", F.array_distinct(_lower(F.col("w"))))
              .where((F.size("b") >= least) & F.arrays_overlap("b", F.array(*[F.lit(x) for x in prefix])))
              .select("doc_id", "text_key", "line_no", F.size("b").alias("n"),
                      F.array_intersect(ranked, F.col("b")).alias("seen")))  # template words, rarest first
    hits = (blocks.withColumn("x", F.explode("seen"))
            .join(F.broadcast(table), "x")      # one row per template and prefix word: fixed size
            .where((F.col("n") >= F.col("need")) & (
                F.least(F.col("size") - F.col("i"),
                        F.size("seen") - F.array_position("seen", F.col("x")) + 1) + F.col("i") >= F.col("need")))
            .dropDuplicates(["doc_id", "text_key", "line_no", "t"]))
    share = F.size(F.array_intersect("ws", "seen"))
    return hits.where(share >= F.col("need")).select(
        "doc_id", "text_key", "line_no", "label", (share / F.col("size")).alias("containment"))


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with the base places, base labels, all labels and
    a score: 1 for a phrase, else the best containment, else 0."""
    base = phrase_hits(docs)
    found = materialise(
        block_matches(docs, templates, threshold).groupBy("doc_id", "text_key")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")), "license")
    found = found.withColumnsRenamed({"doc_id": "_d", "text_key": "_k"})
    both = base.join(found, (F.col("text_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    empty = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_list"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_list", F.coalesce("found", empty))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op4_license_scan(spark, sf_dir) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _oracle() -> str:
    rows = ", ".join(f"({t}, '{label}', [{', '.join(repr(x) for x in _template_words(text))}])"
                     for t, (label, text) in enumerate(TEMPLATES))
    pats = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    span = longest(TEMPLATES)
    at = []
    for label, p in pats.items():
        cond = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(), 1))
        at.append(f"SELECT doc_id, i, '{label}' AS label FROM places WHERE {cond}")
    return rf"""
WITH d AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(coalesce(text, ''),
                  '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> ''), lambda x: lower(x)) AS w,
                  string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
places AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d),
hit AS ({' UNION ALL '.join(at)}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, list_sort(list(DISTINCT label)) AS bl FROM hit GROUP BY doc_id),
tpl AS (SELECT * FROM (VALUES {rows}) AS v(t, label, ws)),
line AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(l,
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> ''), lambda x: lower(x)) AS b
         FROM (SELECT doc_id, unnest(ls) AS l FROM d)),
blk AS (SELECT doc_id, list_distinct(b) AS b FROM line WHERE len(b) <= {2 * span}
        UNION ALL
        SELECT doc_id, list_distinct(w[i + 1:i + {2 * span}]) AS b
        FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {span}, 1), {span})) AS i FROM d)),
m AS (SELECT doc_id, label, len(list_intersect(ws, b)) / len(ws) AS c FROM blk, tpl
      WHERE len(list_intersect(ws, b)) >= ceil({THRESHOLD} * len(ws) - 1e-9)),
found AS (SELECT doc_id, list(DISTINCT label) AS fl, max(c) AS best FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
       coalesce(array_to_string(bl, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bl, []), coalesce(fl, [])))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM d LEFT JOIN base ON d.doc_id = base.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""


ORACLE = _oracle()
