"""Word shingles as 64-bit hashes, and blocks of near-duplicate candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent

BUCKETS = 1 << 22            # of the word-frequency table, a byte each: its size is fixed


class WordHashes(Recent):
    limit = 50_000           # hashing a word again is cheap

    def make(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)


HASHES = WordHashes()        # kept for the next task of a reused worker


def text_word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text with A-Z lower-cased
    (bytes.lower and bytes.split act on ASCII alone)."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    return np.array([HASHES[w] for w in text.encode("utf-8", "replace").lower().split()], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Full-avalanche finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` words; the whole sequence if shorter."""
    size = min(size, len(w))
    if not size:
        return w
    h = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = mix(h + w[k:len(w) - size + 1 + k])
    return h


def word_frequencies(docs: DataFrame) -> np.ndarray:
    """How often words occur over all documents, by hash bucket, as
    4 log2(1 + n) in a byte.  Summed per task, then per bucket; at most
    BUCKETS rows of five bytes reach the driver, as one Arrow table."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(BUCKETS, dtype=np.int32)
        for pdf in batches:
            for text in pdf["text"]:
                b, n = np.unique(text_word_hashes(text) & np.uint64(BUCKETS - 1), return_counts=True)
                sums[b.astype(np.int64)] += n.astype(np.int32)
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"b": at.astype(np.int32), "n": sums[at].astype(np.int64)})

    level = F.least(F.lit(127), F.round(8 * F.log2(F.col("n") + 1)) / 2).cast("tinyint")
    rows = docs.select("text").mapInPandas(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).select(
        "b", level.alias("level")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int8)
    out[rows["b"].to_numpy()] = rows["level"].to_numpy()
    return out


def labels_of(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component in a boolean matrix."""
    n = len(adjacent)
    adjacent = adjacent | np.eye(n, dtype=bool)
    labels = np.arange(n)
    while True:
        new = np.where(adjacent, labels[None, :], n).min(axis=1)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def units(rows: DataFrame, key: str, limit: int, weight: str | None = None, weight_limit: int = 0) -> DataFrame:
    """Deal the rows of each key into units of bounded size.

    A key with more than ``limit`` rows (or ``weight_limit`` of a summed
    weight) is split into blocks by hash of ``rep``, and each pair of blocks
    is a unit, so every two rows of a key meet in a unit and none is larger
    than two blocks.  Adds columns b1, b2."""
    size = [F.count(F.lit(1)).alias("_c")]
    blocks = F.ceil(F.col("_c") / limit)
    if weight:
        size.append(F.sum(weight).alias("_s"))
        blocks = F.greatest(blocks, F.ceil(F.col("_s") / weight_limit))
    sizes = rows.groupBy(key).agg(*size).select(key, blocks.cast("int").alias("_g"))
    block = F.pmod(F.xxhash64("rep"), F.col("_g")).cast("int")
    return (rows.join(sizes, key).withColumn("_b", block)
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
            .withColumn("b1", F.least("_b", "_o")).withColumn("b2", F.greatest("_b", "_o"))
            .drop("_b", "_o", "_g"))


def by_unit(rows: DataFrame, key: str, work, schema: str) -> DataFrame:
    """Apply ``work(pdf of whole units)`` to the rows of units, each unit in
    one task; a unit that goes over a batch is carried into the next."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            same = (pdf[[key, "b1", "b2"]] == pdf[[key, "b1", "b2"]].iloc[-1]).all(axis=1).to_numpy()
            cut = len(pdf) - (int(np.argmin(same[::-1])) if not same.all() else len(pdf))
            if cut:
                yield work(pdf.iloc[:cut].reset_index(drop=True))
            rest = pdf.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield work(rest)

    keys = [key, "b1", "b2"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def unit_bounds(pdf: pd.DataFrame, key: str) -> np.ndarray:
    """Start of each unit in a sorted frame, and the end."""
    k = pdf[[key, "b1", "b2"]].to_numpy()
    return np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, [len(k)]])
