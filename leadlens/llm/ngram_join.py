"""N-gram Jaccard join with several global token orders (operator 2).

Documents are sets of 3-word shingles; two link when their Jaccard
similarity is at least 0.9.

Under any global order of the shingles, two linked sets share at least
``SHARE`` of the first n - ceil(0.9 n) + SHARE shingles of each (prefix
filter with several common shingles; all that must be common, in sets
smaller than that).  Three orders are used: by the corpus frequency of a
shingle's rarest word, of its middle word, and by the summed logarithms of
all, ties by hash.  A document stays only while that many of its prefix
shingles occur in other documents' prefixes under every order so far, so
each order works on what the ones before have left.  Orders affect the cost,
never the result.

1. Documents with equal sets form a class; its smallest doc_id stands for it.
2. Classes that share enough prefix shingles under all orders go on.
3. Prefix shingles of the first order that occur in the same classes are one
   posting list.  Within a list, pairs that pass the length filter and a
   lower bound on the set difference (the distance of the sets' parity
   bitmaps) connect their classes into candidate groups.
4. Within a candidate group the exact intersections are counted, and each
   task hands on a spanning forest of the links it finds: as many rows as
   documents, not pairs.
5. Connected components of these links.

Prefix groups and candidate groups beyond a size are split into blocks, and
every pair of blocks is a unit of work, so no task holds an unbounded group
and no pair is left out.

Defined cases: null and empty texts have the empty set, link with nothing
and are their own component; a null doc_id links with nothing and has a null
component; rows with one doc_id are one node; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, documents, integers_again, integers_as_text, materialise
from .shingles import BUCKETS, by_unit, labels_of, mix, text_word_hashes, unit_bounds, units, windows
from .shingles import word_frequencies

SIZE = 3
PERCENT = 90
BITS = 1024                  # of a parity bitmap
SHARE = 8                    # prefix shingles that a candidate shares under each order
BLOCK_ROWS = 1024            # rows of a block of a prefix group
GROUP_ROWS = 512             # documents, and
GROUP_TOKENS = 1 << 21       # shingles of a block of a candidate group


def overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least;
    also the smallest size of such a set."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """Two linked sets share SHARE shingles (all that must be common, in
    smaller sets) of prefixes of this length under any order."""
    return n - overlap(n, percent) + min(SHARE, overlap(n, percent))


def needed(n: int, percent: int) -> int:
    """Prefix shingles that a set of n shares with any set it links to, the
    smallest possible one included."""
    return min(SHARE, overlap(overlap(n, percent), percent))


class Sets:
    """Shingle sets and their prefixes under the orders."""

    def __init__(self, frequencies: np.ndarray, size: int, percent: int):
        self.levels = frequencies
        self.size, self.percent = size, percent

    def shingles(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingles, and (3, n): the orders' keys."""
        w = text_word_hashes(text)
        h = windows(w, self.size)
        h, first = np.unique(h, return_index=True)
        if not len(h):
            return h, np.zeros((3, 0))
        f = self.levels[(w & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.int16)
        k = min(self.size, len(w))
        parts = np.sort(np.stack([f[i:len(w) - k + 1 + i] for i in range(k)])[:, first].astype(np.int64), axis=0)
        low, mid, top = parts[0], parts[len(parts) // 2], parts[-1]
        return h, np.stack([(low << 16) + (mid << 8) + top, (mid << 8) + low, parts.sum(axis=0)])

    def prefix(self, h: np.ndarray, keys: np.ndarray, order: int) -> np.ndarray:
        if not len(h):
            return h
        at = np.lexsort((mix(h + np.uint64(order + 1)), keys[order]))
        return h[at[:prefix_length(len(h), self.percent)]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def digest(h: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of shingles."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), dtype=np.int64).tolist())


def _first_pass(docs: DataFrame, sets: Sets) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, need, d, e, p = [], [], [], [], []
            for text in pdf["text"]:
                h, keys = sets.shingles(text)
                n.append(len(h))
                need.append(needed(len(h), sets.percent))
                for part, into in zip(digest(h), (d, e), strict=True):
                    into.append(part)
                p.append(signed(sets.prefix(h, keys, 0)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": n, "need": need, "d": d, "e": e, "p0": p})

    docs = docs.select("doc_id", "text")
    return integers_again(integers_as_text(docs).mapInPandas(
        run, "doc_id string, n long, need int, d long, e long, p0 array<long>"), docs)


def _second_pass(docs: DataFrame, sets: Sets) -> DataFrame:
    """For classes' documents (rep, d, e, text): the prefixes and the bitmap of
    the set; texts with another set than the class's are left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rep, d, e, text in zip(pdf["rep"], pdf["d"], pdf["e"], pdf["text"], strict=True):
                h, keys = sets.shingles(text)
                if digest(h) != (d, e):
                    continue
                parity = np.bincount((mix(h + np.uint64(99)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                out.append((rep, len(h), needed(len(h), sets.percent), *[signed(sets.prefix(h, keys, k)) for k in range(3)],
                            np.packbits(parity.astype(np.uint8)).tobytes()))
            yield pd.DataFrame(out, columns=["rep", "n", "need", "p0", "p1", "p2", "bits"])

    return docs.mapInPandas(run, "rep long, n long, need int, p0 array<long>, p1 array<long>, p2 array<long>, bits binary")


def _token_pass(docs: DataFrame, sets: Sets) -> DataFrame:
    """The sets of classes' documents (rep, component, d, e, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(rep, c, h) for rep, c, d, e, h in zip(
                pdf["rep"], pdf["component"], pdf["d"], pdf["e"], [sets.shingles(t)[0] for t in pdf["text"]], strict=True)
                if digest(h) == (d, e)]
            yield pd.DataFrame([(rep, c, len(h), signed(h)) for rep, c, h in found], columns=["rep", "component", "n", "tokens"])

    return docs.mapInPandas(run, "rep long, component long, n long, tokens array<long>")


def _postings(sets: DataFrame, prefix: str) -> DataFrame:
    return sets.select("rep", "need", F.explode(prefix).alias("tok"))


def _shared(postings: DataFrame) -> DataFrame:
    """Shingles in the prefixes of two classes or more."""
    return (postings.groupBy("tok").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
            .where("lo <> hi").select("tok"))


def _stay(postings: DataFrame) -> DataFrame:
    """Classes with as many shared prefix shingles as a link takes."""
    return (postings.join(_shared(postings), "tok").groupBy("rep", "need").agg(F.count(F.lit(1)).alias("n"))
            .where("n >= need").select("rep").distinct())


def _posting_lists(postings: DataFrame) -> DataFrame:
    """Postings of two classes or more, one shingle for all that occur in the
    same classes (equal count and two hashes): these would compare the same pairs."""
    lists = (postings.groupBy("tok").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).where("c > 1"))
    return postings.select("rep", "tok").join(lists.groupBy("c", "x", "y").agg(F.min("tok").alias("tok")).select("tok"), "tok")


def _candidates(percent: int):
    def close(na, nb, distance):
        # |A xor B| <= (nA + nB)(1 - t)/(1 + t), at least the bitmaps' distance
        return (percent * np.maximum(na, nb) <= 100 * np.minimum(na, nb)) & (
            distance * (100 + percent) <= (na + nb) * (100 - percent))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        reps, n = pdf["rep"].to_numpy(), pdf["n"].to_numpy()
        raw = np.frombuffer(b"".join(pdf["bits"]), dtype=np.uint8).reshape(len(pdf), BITS // 8)
        words = raw.view(np.uint64)
        bounds = unit_bounds(pdf, "tok")
        sizes = np.diff(bounds)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        u, v = [], []
        small = sizes[unit] <= 32
        for gap in range(1, int(sizes[sizes <= 32].max(initial=1))):
            i = np.flatnonzero((unit[:-gap] == unit[gap:]) & small[:-gap]) if gap < len(unit) else []
            if len(i):
                distance = np.bitwise_count(words[i] ^ words[i + gap]).sum(axis=1)
                ok = close(n[i], n[i + gap], distance.astype(np.int64)) & (reps[i] != reps[i + gap])
                u.append(reps[i[ok]])
                v.append(reps[i[ok] + gap])
        for k in np.flatnonzero(sizes > 32):
            at = slice(bounds[k], bounds[k + 1])
            x = np.unpackbits(raw[at], axis=1).astype(np.float32) * 2 - 1
            distance = np.rint((BITS - x @ x.T) / 2).astype(np.int64)
            labels = labels_of(close(n[at][:, None], n[at][None, :], distance))
            hit = np.flatnonzero(labels != np.arange(len(labels)))
            u.append(reps[at][hit])
            v.append(reps[at][labels[hit]])
        out = pd.DataFrame({"u": np.concatenate(u or [[]]), "v": np.concatenate(v or [[]])})
        return out.astype("int64")

    return work


def linked(tokens: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of the links between sets of distinct tokens, exact."""
    n = np.array([len(t) for t in tokens])
    rows = np.repeat(np.arange(len(tokens)), n)
    _, column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    keep = count[column] > 1                                   # others meet nothing here
    rows, column = rows[keep], np.unique(column[keep], return_inverse=True)[1]
    common = np.zeros((len(tokens), len(tokens)), dtype=np.int64)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    step = max(1, 4_000_000 // len(tokens))
    top = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, top, step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((len(tokens), min(step, top - low)), dtype=np.float32)
        part[rows[a:b], column[a:b] - low] = 1
        common += np.rint(part @ part.T).astype(np.int64)
    return 100 * common >= percent * (n[:, None] + n[None, :] - common)


def _verify(percent: int):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        reps, tokens = pdf["rep"].to_numpy(), pdf["tokens"].to_list()
        bounds = unit_bounds(pdf, "component")
        u, v = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                labels = labels_of(linked(tokens[a:b], percent))
                hit = np.flatnonzero(labels != np.arange(len(labels)))
                u.append(reps[a:b][hit])
                v.append(reps[a:b][labels[hit]])
        out = pd.DataFrame({"u": np.concatenate(u or [[]]), "v": np.concatenate(v or [[]])})
        return out.astype("int64")

    return work


def jaccard_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    sets = Sets(word_frequencies(docs), size, percent)
    first = materialise(_first_pass(docs, sets).withColumn("r", F.monotonically_increasing_id()), "ngram-first")
    known = first.where("n > 0 and doc_id is not null")
    # a class of equal sets: its number is that of its first row, its owner the smallest id with that set
    classes = materialise(known.groupBy("d", "e").agg(F.min("r").alias("rep"), F.min("doc_id").alias("owner")), "ngram-classes")
    # a doc_id on rows with different texts stands in several classes, and joins them
    members = materialise(known.select("doc_id", "d", "e").join(classes, ["d", "e"]).select("doc_id", "owner").distinct(),
                          "ngram-members")
    own = known.join(classes.select("rep"), F.col("r") == F.col("rep")).select("rep", "need", "p0")
    keep = materialise(_stay(_postings(own, "p0")), "ngram-order0")
    counted = materialise(first.select("doc_id", F.col("n").alias("n_shingles")), "ngram-counted")
    discard(first)

    # all texts of the owner's id; the passes take those with the class's set
    text = docs.select(F.col("doc_id").alias("owner"), "text")
    second = materialise(_second_pass(classes.join(keep, "rep").join(text, "owner").select("rep", "d", "e", "text"), sets)
                         .dropDuplicates(["rep"]), "ngram-second")
    for order, prefix in ((1, "p1"), (2, "p2")):
        rest = materialise(_stay(_postings(second.select("rep", "need", prefix).join(keep, "rep"), prefix)), f"ngram-order{order}")
        discard(keep)
        keep = rest

    lists = _posting_lists(_postings(second.select("rep", "need", "p0").join(keep, "rep"), "p0"))
    light = materialise(lists.join(second.select("rep", "n", "bits"), "rep"), "ngram-light")
    discard(second, keep)
    pairs = materialise(by_unit(units(light, "tok", BLOCK_ROWS), "tok", _candidates(percent), "u long, v long").distinct(),
                        "ngram-pairs")
    discard(light)
    groups = components(pairs, "ngram-groups")
    discard(pairs)
    chosen = classes.join(groups.withColumnRenamed("node", "rep"), "rep").join(text, "owner").select(
        "rep", "component", "d", "e", "text")
    full = materialise(_token_pass(chosen, sets).dropDuplicates(["rep"]), "ngram-sets")
    links = by_unit(units(full, "component", GROUP_ROWS, "n", GROUP_TOKENS), "component",
                    _verify(percent), "u long, v long")
    owner = lambda c: classes.select(F.col("rep").alias(c), F.col("owner").alias(f"{c}_owner"))
    links = links.join(owner("u"), "u").join(owner("v"), "v").select(F.col("u_owner").alias("u"), F.col("v_owner").alias("v"))
    same = members.select(F.col("doc_id").alias("u"), F.col("owner").alias("v")).where("u <> v")
    links = materialise(links.unionAll(same).distinct(), "ngram-links")
    discard(full, groups, classes, members)
    final = components(links, "ngram-components")
    discard(links)
    return (counted.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def keep_representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each group: the smallest
    doc_id, with all rows of that id; rows without an id stay."""
    found = jaccard_components(docs, size, percent).select(F.col("doc_id").alias("_id"), "component_id")
    gone = found.where("component_id <> _id").select("_id").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_doc"))
    kept = row.join(gone, F.col("_doc") == F.col("_id"), "left_anti").select("_row.*")
    return kept


def op2_ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
