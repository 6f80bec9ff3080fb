"""Substring dedup by paragraph MinHash banding (operator 1).

A passage that other documents hold too is removed from all but the one with
the smallest doc_id.  Two kinds of paragraph are compared, on lower-cased
words:

* lines of at least ``SHINGLE`` words, and hard-wrapped paragraphs (lines of
  fewer than ``LINE_WORDS`` words that follow one another without a blank
  line) as wholes, wherever their lines break, as sets of 5-word shingles:
  MinHash bands, all lines of a band compared with one another, exact Jaccard
  >= 0.8 within the groups that this leaves, connected components of the
  verified pairs;
* pieces of running text between content-defined cuts, which find passages
  that start or end inside a line.  A word is a cut where its hash is the
  smallest among its neighbours, so equal passages are cut alike wherever
  they stand.  Pieces have about seven words; at that length a Jaccard of
  0.8 over 5-word shingles means equal words, so a piece has one band, the
  hash of all of it.  A word or phrase of up to three words repeated in place
  has no cut inside, so such a stretch is one piece with what surrounds it.

Duplicate paragraphs that touch in a document are joined into runs, and runs
of at least ``MIN_RUN`` words are removed, whatever lines they stand in;
single pieces and short lines that recur by chance stay.  A near copy that
starts or ends inside a line, or in wrapped lines that run on without a blank
line, is found only in its equal stretches.

Bands: 6 of 3 values.  A pair with Jaccard 0.8 meets with probability 0.986,
0.9 with 0.9996.

Hot paragraphs: equal lines are one class, a minimum and maximum per key,
partially aggregated in each task.  The different lines of a band, and of a
group, are split into blocks of bounded size; every pair of blocks is a unit
of work that hands on a spanning forest, not pairs.

Defined cases: null and empty texts have no paragraphs; rows with a null
doc_id are left alone and seen by no other; rows that repeat a doc_id with
equal text are one document; a doc_id with different texts is compared but
not cut; an empty table gives an empty table; other columns are carried,
never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, documents, materialise
from .ngram_join import BITS, BLOCK_ROWS, GROUP_ROWS, GROUP_TOKENS, _candidates, _posting_lists, _verify
from .shingles import HASHES, by_unit, mix, text_word_hashes, units, windows

LINE_WORDS = 50              # shorter lines are parts of paragraphs too; one changed word leaves 0.8 of 50
SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 6, 3
REACH = 3                    # neighbours on each side that a cut is below
MIN_RUN = 30
BLOCK_WORDS = 200_000        # lines hashed in one call
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)   # odd multipliers
WORD = re.compile(r"[^\x20\x09-\x0D]+")
POWERS = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""
    if len(POWERS["up"]) < n:
        for name, b in (("up", BASE), ("down", BACK)):
            x = np.full(2 * n, b, dtype=np.uint64)
            x[0] = 1
            POWERS[name] = np.cumprod(x)
    return POWERS["up"][:n], POWERS["down"][:n]


def pieces(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, hash) of the pieces between cuts; the text's two ends
    bound pieces as well."""
    n = len(w)
    if not n:
        return np.zeros(0, int), np.zeros(0, int), w
    h = mix(w)
    cut = np.ones(n, dtype=bool)
    for k in range(1, REACH + 1):
        if n > k:
            cut[k:] &= h[k:] < h[:-k]
            cut[:-k] &= h[:-k] <= h[k:]
    cut[:REACH] = False
    cut[max(0, n - REACH):] = False
    start = np.concatenate([[0], np.flatnonzero(cut)])
    end = np.concatenate([start[1:], [n]])
    up, down = _powers(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up[:n])])
    value = (total[end] - total[start]) * down[start]
    return start, end - start, mix(value + (end - start).astype(np.uint64))


def line_parts(text: str) -> Iterator[tuple[int, list[bytes]]]:
    """(start word, lower-cased words) of the lines of at least SHINGLE words,
    and of the paragraphs: neighbouring lines of fewer than LINE_WORDS words
    without a blank line between them."""
    at, paragraph, lines = 0, [], 0
    for line in [*text.encode("utf-8", "replace").lower().split(b"\n"), b""]:
        parts = line.split()
        if len(parts) >= SHINGLE:
            yield at, parts
        if 0 < len(parts) < LINE_WORDS:
            paragraph += parts
            lines += 1
        else:
            if lines > 1 and len(paragraph) >= SHINGLE:
                yield at - len(paragraph), paragraph
            paragraph, lines = [], 0
        at += len(parts)


def line_keys(parts: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and band keys of each line of a block; ``parts`` are the words of
    all its lines, ``n`` the number of words of each."""
    w = np.array([HASHES[x] for x in parts], dtype=np.uint64)
    first = np.cumsum(n) - n
    place = np.arange(len(w)) - np.repeat(first, n)
    up, _ = _powers(int(n.max()))
    hashes = mix(np.add.reduceat(w * up[place], first) + n.astype(np.uint64))
    # shingles of the whole block, less those that lie across two lines
    shingles = windows(w, SHINGLE)
    shingles = shingles[(place <= np.repeat(n, n) - SHINGLE)[:len(shingles)]]
    count = n - SHINGLE + 1
    begin = np.cumsum(count) - count
    keys = []
    for band in range(BANDS):
        key = np.full(len(n), band, dtype=np.uint64)
        for seed in SEEDS[band * ROWS:(band + 1) * ROWS]:
            x = shingles * seed
            key = mix(key + np.minimum.reduceat(x ^ (x >> np.uint64(29)), begin))
        keys.append(key)
    return hashes, np.stack(keys, axis=1)


def line_hash(w: np.ndarray) -> int:
    up, _ = _powers(len(w))
    return int(mix((w * up).sum(keepdims=True) + np.uint64(len(w))).view(np.int64)[0])


def _pieces(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, ids = [], []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                s, n, h = pieces(text_word_hashes(text))
                out.append((s, n, h))
                ids.append(np.full(len(s), doc, dtype=np.int64))
            if out:
                s, n, h = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"h": h.astype(np.uint64).view(np.int64), "doc_id": np.concatenate(ids),
                                    "start": s.astype(np.int32), "length": n.astype(np.int32)})

    return docs.mapInPandas(run, "h long, doc_id long, start int, length int")


def _lines(docs: DataFrame) -> DataFrame:
    def rows(block: list[tuple], parts: list[bytes]) -> pd.DataFrame:
        doc, start, n = (np.array(x, dtype=np.int64) for x in zip(*block, strict=True))
        h, bands = line_keys(parts, n)
        return pd.DataFrame({"h": h.view(np.int64), "doc_id": doc, "start": start.astype(np.int32),
                             "length": n.astype(np.int32), "bands": list(bands.view(np.int64))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, parts = [], []
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                for at, p in line_parts(text):
                    block.append((doc, at, len(p)))
                    parts += p
                    if len(parts) >= BLOCK_WORDS:
                        yield rows(block, parts)
                        block, parts = [], []
        if block:
            yield rows(block, parts)

    return docs.mapInPandas(run, "h long, doc_id long, start int, length int, bands array<long>")


def _line_sets(docs: DataFrame) -> DataFrame:
    """(rep, n, tokens, bits) of the lines whose hashes are listed in column
    ``wanted``: the distinct shingles and their parity bitmap."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, wanted in zip(pdf["text"], pdf["wanted"], strict=True):
                wanted = set(wanted.tolist())
                for _, parts in line_parts(text):
                    w = np.array([HASHES[x] for x in parts], dtype=np.uint64)
                    h = line_hash(w)
                    if h in wanted:
                        wanted.remove(h)
                        x = np.unique(windows(w, SHINGLE))
                        parity = np.bincount((mix(x + np.uint64(99)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                        out.append((h, len(x), x.view(np.int64), np.packbits(parity.astype(np.uint8)).tobytes()))
            yield pd.DataFrame(out, columns=["rep", "n", "tokens", "bits"])

    return docs.mapInPandas(run, "rep long, n long, tokens array<long>, bits binary")


def near_line_pairs(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Spanning forest (u, v) of the links, Jaccard >= PERCENT, between line
    classes.  All classes of a band are compared, in blocks; those whose sizes
    and bitmaps allow a link form groups, and every pair of a group is verified."""
    lists = materialise(_posting_lists(classes.select(F.col("h").alias("rep"), F.explode("bands").alias("tok"))),
                        "passage-lists")
    need = lists.select(F.col("rep").alias("h")).distinct()
    where = (classes.select("h", "doc").join(need, "h").groupBy(F.col("doc").alias("doc_id"))
             .agg(F.collect_list("h").alias("wanted")))      # lines of one document
    text = docs.join(where, "doc_id").select("text", "wanted")
    sets = materialise(_line_sets(text).dropDuplicates(["rep"]), "passage-sets")
    light = materialise(lists.join(sets.select("rep", "n", "bits"), "rep"), "passage-light")
    pairs = materialise(by_unit(units(light, "tok", BLOCK_ROWS), "tok", _candidates(PERCENT), "u long, v long").distinct(),
                        "passage-pairs")
    discard(lists, light)
    groups = components(pairs, "passage-groups")
    full = materialise(sets.drop("bits").join(groups.withColumnRenamed("node", "rep"), "rep"), "passage-grouped")
    discard(pairs, sets, groups)
    links = materialise(by_unit(units(full, "component", GROUP_ROWS, "n", GROUP_TOKENS), "component",
                                _verify(PERCENT), "u long, v long").distinct(), "passage-links")
    discard(full)
    return links


def duplicate_spans(table: DataFrame) -> DataFrame:
    """Spans to remove: doc_id, start and length in words, kept_doc_id (the
    smallest document that keeps the passage) and component_id."""
    docs = table.select("doc_id", "text").where("doc_id is not null and text is not null")
    lines = materialise(_lines(docs), "passage-lines")
    every = materialise(
        lines.groupBy("h").agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("last"),
                               F.first("bands").alias("bands")), "passage-classes")
    links = near_line_pairs(docs, every)
    groups = components(links, "passage-components")
    classes = every.select("h", "doc", "last").join(groups.withColumnRenamed("node", "h"), "h", "left") \
        .withColumn("component", F.coalesce("component", "h"))
    kept = classes.groupBy("component").agg(F.min("doc").alias("kept"), F.max("last").alias("last")).where("kept <> last")
    line_of = classes.select("h", "component").join(kept.select("component", "kept"), "component")
    found = lines.select("h", "doc_id", "start", "length").join(line_of, "h").where("doc_id <> kept") \
        .select("doc_id", "start", "length", "kept", "component")

    # pieces are cut in each of two passes over the text rather than stored
    repeated = materialise(
        _pieces(docs).groupBy("h").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("last"))
        .where("kept <> last").select("h", "kept"), "passage-repeated")
    more = _pieces(docs).join(repeated, "h").where("doc_id <> kept") \
        .select("doc_id", "start", "length", "kept", F.col("h").alias("component"))
    units = materialise(found.unionAll(more).distinct(), "passage-units")
    discard(lines, every, links, groups, repeated)

    # runs of touching or overlapping units: a window per document
    own = Window.partitionBy("doc_id").orderBy("start", "length", "kept", "component")
    before = F.max(F.col("start") + F.col("length")).over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = (units.withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int"))
            .withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "run").agg(
                F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"),
                F.min("kept").alias("kept_doc_id"), F.min("component").alias("component_id"))
            .where(F.col("end") - F.col("start") >= MIN_RUN))
    unclear = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")) \
        .where("a <> b").select("doc_id")
    return runs.join(unclear, "doc_id", "left_anti").select(
        "doc_id", F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start")).cast("long").alias("length"),
        "kept_doc_id", "component_id")


def cut_words(text: str, starts, lengths) -> str:
    """``text`` without the given runs of words (ascending, disjoint)."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for s, n in zip(starts, lengths, strict=True):
        out.append(text[at:spans[s][0]])
        at = spans[s + n - 1][1]
    return "".join([*out, text[at:]])


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with duplicate passages cut out of ``text``; a document all of
    whose words went is dropped, every other row and column stays."""
    spans = (duplicate_spans(docs).groupBy(F.col("doc_id").alias("_id"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_cut")))

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if r is None or t is None else cut_words(t, [x["start"] for x in r], [x["length"] for x in r])
                          for t, r in zip(text, runs, strict=True)], dtype=object)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_doc"))
    out = row.join(spans, F.col("_doc") == F.col("_id"), "left")
    out = out.withColumn("_text", cut(F.col("_row.text"), F.col("_cut")))
    return (out.where(F.col("_cut").isNull() | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
            .select(F.col("_row").withField("text", F.col("_text")).alias("_row")).select("_row.*"))


def op1_paragraph_minhash(spark, sf_dir) -> DataFrame:
    return duplicate_spans(documents(spark, sf_dir))
