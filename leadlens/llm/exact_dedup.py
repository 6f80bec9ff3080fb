"""Exact dedup by content-defined chunk recipes (operator 13).

A text is normalised (each run of ASCII white space becomes one space) and
cut into chunks: a chunk ends at the first sentence mark with a space after
``LEAST`` characters, at ``MOST`` characters at the latest.  The places of the
cuts depend on the text alone, so equal texts have equal chunks.

All chunks of the corpus are deduplicated into a dictionary, keyed by a
128-bit hash; a hash that stands for one text only is a verified identifier.
A document's recipe is the ordered list of its identifiers, and documents are
compared by recipes.  So a text is moved once, chunk by chunk and after
equal chunks of a task have been merged; all that follows moves identifiers.
Texts with a chunk whose hash stands for two different chunks have no recipe
of verified identifiers: they are compared as whole texts, in a branch of
their own that runs only if there are such hashes.

A group of copies of any size is aggregated per task, then in ``SALTS`` parts,
then whole, and the group's result goes back to its rows by part, so no task
reads all rows of a large group.

Column functions only.  Defined cases: null and empty texts are equal to one
another and have an empty recipe; a very long text has a long recipe of
bounded chunks; of rows with equal text and equal smallest doc_id one stays;
a null doc_id stays only where all ids of the group are null (keep_id is then
null); an empty table gives an empty table; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialise

LEAST, MOST = 1024, 8192     # characters of a chunk
SALTS = 64                   # parts in which a group is aggregated

# Runs of white space other than a single space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
CHUNK = rf"(?s).{{{LEAST},{MOST - 2}}}?[.!?] |.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    """The text with one space for each run of white space; empty for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def chunks(norm: Column) -> Column:
    """The content-defined chunks; joined together they are the text."""
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(13), chunk).alias("b"))


def chunk_dictionary(docs: DataFrame, hashed: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """(h, texts): each chunk hash of the corpus and how many different chunks
    it stands for.  The only step that moves text."""
    return (docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
            .select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
            .groupBy("h").agg(F.count(F.lit(1)).alias("texts")))


def _groups(rows: DataFrame, key: str) -> DataFrame:
    """Attach keep_id, keep_row and group_size of the rows with equal ``key``."""
    first = lambda: F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("r"), F.lit(SALTS)))
    parts = salted.groupBy(key, "salt").agg(F.min(first()).alias("first"), F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy(key).agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    back = parts.select(key, "salt").join(whole, key)
    return (salted.join(back, [key, "salt"])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("r") == F.col("first.r")).alias("kept"), "text_sha256"))


def dedup(docs: DataFrame, hashed: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select("doc_id", "text")
    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    rows = materialise(texts.select(
        F.monotonically_increasing_id().alias("r"), "doc_id", F.sha2("norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("norm")), hashed).alias("recipe")), "recipes")
    clashes = materialise(chunk_dictionary(docs, hashed).where("texts > 1").select("h"), "chunk-clashes")
    if clashes.isEmpty():
        return _groups(rows, "recipe")

    # recipes that hold a hash of several chunks
    doubtful = (rows.select("r", F.explode("recipe").alias("h")).join(clashes, "h").select("r").distinct())
    sure = rows.join(doubtful, "r", "left_anti")
    held = texts.select("doc_id", "norm", F.transform(chunks(F.col("norm")), hashed).alias("recipe"))
    held = materialise(held.select(F.monotonically_increasing_id().alias("r"), "*"), "held")
    again = held.select("r", F.explode("recipe").alias("h")).join(clashes, "h").select("r").distinct()
    whole = held.join(again, "r").select("r", "doc_id", "norm", F.sha2("norm", 256).alias("text_sha256"))
    return _groups(sure, "recipe").unionByName(_groups(whole, "norm"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one
    with the smallest doc_id."""
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("r"), F.struct(*docs.columns).alias("row")),
                       "exact-rows")
    # the row number stands in for the id, so that repeated ids stay apart
    marks = dedup(rows.select(F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"),
                                       "r").alias("doc_id"), F.col("row.text").alias("text")))
    kept = marks.where("kept").select(F.col("doc_id.r").alias("r"))
    return rows.join(kept, "r", "left_semi").select("row.*")


def op13_chunk_recipes(spark, sf_dir) -> DataFrame:
    return dedup(documents(spark, sf_dir))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
n AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS k
  FROM t)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM n
"""
