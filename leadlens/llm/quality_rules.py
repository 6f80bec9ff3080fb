"""Host-level quality rules (operator 3), DataFrame functions only.

Each document is measured by per-text rules.  Rule failures are aggregated
by host (column ``source``); a host's failure rate is shrunk towards the
corpus rate by a beta prior fitted to the hosts by moments, and the host's
verdict is joined back to its documents.

Defined cases: null text counts as empty (no words, so it fails); a null
host is a host of its own; repeated rows are measured alike, each counts;
an empty table gives an empty table; columns of the input whose names clash
with the measures are not read and not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, documents, let, materialise, words

MIN_WORDS = 50               # fewer words: rejected (contract)
MAX_REPEAT_PERCENT = 50      # more repeated words: rejected (contract)
MAX_SYMBOL_PERCENT = 30      # host rule: symbols per 100 word characters
MAX_DUP_LINE_PERCENT = 50    # host rule: repeated lines per 100 lines with a word
MAX_HOST_RATE = 0.9          # a host is rejected when its shrunk failure rate is above
PRIOR_STRENGTH = (1.0, 1e6)  # bounds of the prior's weight in documents


def _repeat_words(h: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs at least twice.
    ``h``: window hashes in text order.  Sort by hash, keep windows equal to
    a neighbour, and sum the covered words in text order."""
    marked = let(
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
        lambda s: F.filter(s, lambda e, k: ((k > 0) & (F.get(s, k - 1)["x"] == e["x"]))
                           | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False))))
    at = F.sort_array(F.transform(marked, lambda e: e["i"]))
    return F.aggregate(
        at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])


def with_measures(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words
    (longs) and base_failed to a table with a ``text`` column."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = df.withColumn("_w", words(F.col("text")))
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "_h": F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))),
    })
    df = df.withColumns({
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(
            F.col("_h").isNotNull() & (F.size(F.array_distinct("_h")) < F.size("_h")),
            _repeat_words(F.col("_h"))).otherwise(F.lit(0).cast("long")),
    }).drop("_w", "_h", "_lines")
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, host_rate, host_failed) from measured documents with a ``host``.

    Failures of any rule are pre-aggregated per task, so a host with a third
    of all documents is a handful of rows.  The prior needs three sums over
    the hosts, the only values that reach the driver."""
    fails = (F.col("base_failed")
             | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
             | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))
    hosts = materialise(
        measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(fails.cast("long")).alias("f")), "hosts")
    got = hosts.agg((F.sum("f") / F.sum("n")).alias("m"), F.var_pop(F.col("f") / F.col("n")).alias("v")).first()
    m, v = got["m"] or 0.0, got["v"] or 0.0
    low, high = PRIOR_STRENGTH
    strength = min(high, max(low, m * (1 - m) / v - 1)) if v > 0 else high
    rate = (F.col("f") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", rate.alias("host_rate"), (rate > MAX_HOST_RATE).alias("host_failed"))


def judged(measured: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Join the host verdicts back (null hosts included) and decide."""
    v = verdicts.withColumnRenamed("host", "_host")
    return (measured.join(v, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, host_failed, kept."""
    measured = materialise(
        with_measures(docs.select("doc_id", "text", F.col("source").alias("host"))).drop("text"), "quality")
    return judged(measured, host_verdicts(measured))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The measured rows are written once with their own columns packed in one
    struct, so extra columns may have any name."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col("text"), F.col("source").alias("host"))
    measured = materialise(with_measures(packed).drop("text"), "quality-rows")
    kept = judged(measured, host_verdicts(measured)).where("kept")
    return kept.select("_row.*")


def op3_host_quality_rules(spark, sf_dir) -> DataFrame:
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed")


ORACLE = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT t.doc_id, source, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars
             OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines THEN 1 ELSE 0 END) AS f FROM b GROUP BY source),
prior AS (SELECT sum(f) / sum(n) AS mean, var_pop(f / n) AS v FROM h),
s AS (SELECT mean, CASE WHEN v > 0 THEN least({PRIOR_STRENGTH[1]}, greatest({PRIOR_STRENGTH[0]}, mean * (1 - mean) / v - 1))
             ELSE {PRIOR_STRENGTH[1]} END AS k FROM prior),
verdict AS (SELECT source, (f + mean * k) / (n + k) > {MAX_HOST_RATE} AS host_failed FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM b JOIN verdict ON b.source IS NOT DISTINCT FROM verdict.source
"""
