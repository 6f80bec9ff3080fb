"""Hard-negative mining with Four-Russians scoring (operator 12).

Components become integers, floor(256 * x).  A candidate is stored as bit
planes: the two's-complement bits of eight neighbouring components, plane by
plane, are one byte each.  For an anchor, the sums of all 256 subsets of each
group of eight components are tabulated; the inner product with a candidate is
then, plane by plane, the sum over the groups of the table entry at the
candidate's byte, shifted by the plane's weight and added (subtracted for the
sign plane).  The scores are full and exact; none is estimated or skipped.

Anchors (ids divisible by 50) are a stated query set: they are dealt to blocks
of ``ANCHOR_ROWS`` and all rows to blocks of ``ROW_ROWS``, and each pair of
blocks is one task's unit, so memory does not depend on the table's size.  The
first pass scores an anchor with the rows of its own label and keeps its first
``POSITIVES``; the second scores it with all other rows and keeps, for each
distinct score of its positives, the first ``NEGATIVES`` inside the band that
the score allows.  Units hand on only what they keep; the merge is a rank over
these few rows per anchor.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; only vectors of one length are compared (an empty
vector scores 0); a null vec_id is no anchor, comes last among ties and can be
a positive or negative; each row counts by itself, so rows with equal ids are
separate anchors and each other's "other rows"; scores beyond 64 bits wrap
around as Spark's longs do; fewer positives or negatives than asked for are
all returned; an empty table gives an empty table; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import materialise

ANCHOR_EVERY, CHANGED_EVERY, LABELS, SCALE = 50, 7, 10, 256   # fixed by the task
POSITIVES, NEGATIVES = 5, 3
ANCHOR_ROWS = 4096           # of a block of anchors
ROW_ROWS = 8192              # of a block of rows
TILE = 128                   # anchors whose tables are held together
GROUP = 8                    # components of a table
LEAST = np.iinfo(np.int64).min

KEPT = "anchor long, band long, score long, id long, no_id boolean, n long"


# ---- rows --------------------------------------------------------------------

def participants(table: DataFrame) -> DataFrame:
    """(r, vec_id, label, x): usable rows with a row number, the changed label
    and integer components."""
    x = F.col("embedding")
    ok = F.col("label").isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    changed = F.when(F.col("vec_id") % CHANGED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return table.select("vec_id", "label", "embedding").where(F.coalesce(ok, F.lit(False))).select(
        F.monotonically_increasing_id().alias("r"), "vec_id", changed.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE)).alias("x"))


def bit_planes(x: np.ndarray) -> bytes:
    """Integer components as bytes: the number of planes, then plane by plane
    from the lowest, a byte for each eight components; the last plane holds
    the signs."""
    planes = 1 + max(int(x.max(initial=0)).bit_length(), int(-1 - x.min(initial=0)).bit_length())
    bits = ((x[None, :] >> np.arange(planes, dtype=np.int64)[:, None]) & 1).astype(np.uint8)
    return bytes([planes]) + np.packbits(bits, axis=1, bitorder="little").tobytes()


def _packed(batches):
    for batch in batches:
        rows = batch.column("x").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("r", "vec_id", "label")]
            + [pa.array([len(x) for x in rows], pa.int32()),
               pa.array([bit_planes(np.array(x, dtype=np.int64)) for x in rows], pa.binary())],
            names=["r", "vec_id", "label", "dims", "planes"])


# ---- scoring -----------------------------------------------------------------

def unpack(packed: list[bytes], dims: int) -> np.ndarray:
    """(rows, planes, groups) bytes of vectors of one length; rows with fewer
    planes repeat their sign plane, which leaves their value as it is."""
    groups = -(-dims // GROUP)
    most = max((p[0] for p in packed), default=1)
    out = np.empty((len(packed), most, groups), dtype=np.uint8)
    for k, p in enumerate(packed):
        own = np.frombuffer(p, dtype=np.uint8, offset=1).reshape(p[0], groups)
        out[k, :p[0]], out[k, p[0]:] = own, own[-1]
    return out


def components(planes: np.ndarray, dims: int) -> np.ndarray:
    """The integers that the planes stand for, padded to whole groups."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weight = np.left_shift(np.int64(1), np.arange(planes.shape[1], dtype=np.int64))
    weight[-1] = -weight[-1]
    return np.tensordot(weight, bits, axes=(0, 1))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of each subset of each group of eight."""
    n, width = anchors.shape
    x = anchors.reshape(n, width // GROUP, GROUP).transpose(1, 2, 0).astype(kind)
    out = np.zeros((width // GROUP, 1 << GROUP, n), dtype=kind)
    for k in range(GROUP):
        out[:, 1 << k:2 << k] = out[:, :1 << k] + x[:, k:k + 1]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchors, rows) inner products by table look-ups, shifts and additions."""
    n, most, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    one = np.empty_like(total)
    for b in range(most):
        plane = np.zeros_like(total)
        for g in range(groups):
            np.take(tables[g], planes[:, b, g], axis=0, out=one)
            plane += one
        plane <<= b
        total = total - plane if b == most - 1 else total + plane
    return total.T


def fits(anchors: np.ndarray, rows: np.ndarray) -> type:
    """32 bits where no score can go over them."""
    bound = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (anchors, rows)]
    return np.int32 if bound[0] * bound[1] * max(1, anchors.shape[1]) < 2**30 else np.int64


def first_in_band(score: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(band, row) of each band's first k columns by score, then column, with
    score <= most; ``score`` has a line for each band."""
    n = score.shape[1]
    key = np.where(score <= most[:, None], score.astype(np.int64), LEAST)
    if n > k:
        # columns below the k-th score are out; ties at it go by column
        bar = np.partition(key, n - k, axis=1)[:, n - k]
        over = key >= np.maximum(bar, LEAST + 1)[:, None]
    else:
        over = key > LEAST
    band, row = np.nonzero(over)
    order = np.lexsort((row, -key[band, row], band))
    band, row = band[order], row[order]
    rank = np.arange(len(band)) - np.searchsorted(band, band)
    return band[rank < k], row[rank < k]


def _unit(anchors: pa.Table, rows: pa.Table, positives: bool) -> pa.Table:
    out: list[tuple[np.ndarray, ...]] = []
    if anchors.num_rows and rows.num_rows:
        by_dims = anchors.column("dims").to_numpy()
        for dims in np.unique(by_dims).tolist():
            a = anchors.filter(pa.array(by_dims == dims))
            r = rows.filter(pa.array(rows.column("dims").to_numpy() == dims))
            if r.num_rows:
                out += _unit_of(a, r, int(dims), positives)
    cols = [np.concatenate([x[k] for x in out]) if out else np.zeros(0, dtype=np.int64) for k in range(6)]
    return pa.table({"anchor": pa.array(cols[0], pa.int64()), "band": pa.array(cols[1], pa.int64()),
                     "score": pa.array(cols[2], pa.int64()), "id": pa.array(cols[3], pa.int64()),
                     "no_id": pa.array(cols[4].astype(bool)), "n": pa.array(cols[5], pa.int64())})


def _unit_of(anchors: pa.Table, rows: pa.Table, dims: int, positives: bool) -> list[tuple[np.ndarray, ...]]:
    ids = rows.column("vec_id")
    no_id = ids.is_null().to_numpy()
    ids = ids.fill_null(0).to_numpy()
    order = np.lexsort((ids, no_id))                     # ties go by id, null last
    ids, no_id = ids[order], no_id[order]
    number, label = rows.column("r").to_numpy()[order], rows.column("label").to_numpy()[order]
    planes = unpack(rows.column("planes").take(pa.array(order)).to_pylist(), dims)
    values = components(unpack(anchors.column("planes").to_pylist(), dims), dims)
    kind = fits(values, components(planes, dims))
    a_number, a_label = anchors.column("r").to_numpy(), anchors.column("label").to_numpy()
    bands = None if positives else anchors.column("bands").to_pylist()
    out = []
    for lab in np.unique(a_label):
        mine = np.flatnonzero(a_label == lab)
        at = np.flatnonzero(label == lab if positives else label != lab)
        if not len(at):
            continue
        for lo in range(0, len(mine), TILE):
            tile = mine[lo:lo + TILE]
            s = scores(subset_sums(values[tile], kind), planes[at]).astype(np.int64)
            if positives:
                own = a_number[tile][:, None] == number[at][None, :]
                line, score = np.arange(len(tile)), s
                score[own] = LEAST
                high = np.full(len(tile), np.iinfo(np.int64).max)
                k, band = POSITIVES, np.zeros(len(tile), dtype=np.int64)
            else:
                line = np.repeat(np.arange(len(tile)), [len(bands[t]) for t in tile])
                band = np.array([p for t in tile for p in bands[t]], dtype=np.int64)
                score = s[line]
                low = -(-band // 2)                      # 50 p <= 100 n
                high = np.array([95 * int(p) // 100 for p in band], dtype=np.int64)
                score = np.where(score >= low[:, None], score, LEAST)
                k = NEGATIVES
            if not len(line):
                continue
            b, row = first_in_band(score, high, k)
            out.append((a_number[tile[line[b]]], band[b], score[b, row], ids[at[row]], no_id[at[row]].astype(np.int64),
                        number[at[row]]))
    return out


# ---- Spark job ---------------------------------------------------------------

def _blocks(rows: DataFrame, anchors: DataFrame, positives: bool) -> DataFrame:
    """What every unit of a block of anchors and a block of rows keeps."""
    n_a, n_r = [max(1, -(-df.count() // size)) for df, size in ((anchors, ANCHOR_ROWS), (rows, ROW_ROWS))]
    block = lambda n: F.pmod(F.xxhash64("r"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a", block(n_a)).withColumn("c", every(n_r))
    right = rows.withColumn("c", block(n_r)).withColumn("a", every(n_a))
    work: Callable = lambda x, y: _unit(x, y, positives)
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(work, KEPT)


def _first(kept: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and band, with their rank."""
    w = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "no_id", "id", "n")
    return kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _id() -> Column:
    return F.when(~F.col("no_id"), F.col("id"))


def mine(table: DataFrame) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score."""
    rows = materialise(participants(table).mapInArrow(
        _packed, "r long, vec_id long, label long, dims int, planes binary"), "bit-planes")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    positives = materialise(_first(_blocks(rows, anchors, True), POSITIVES).select(
        "anchor", _id().alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")),
        "positives")
    bands = positives.groupBy("anchor").agg(F.collect_set("positive_score").alias("bands"))   # at most POSITIVES
    banded = materialise(anchors.join(bands, F.col("r") == F.col("anchor")).drop("anchor"), "anchors")
    negatives = _first(_blocks(rows, banded, False), NEGATIVES).select(
        "anchor", F.col("band").alias("positive_score"), "rank", _id().alias("negative_id"),
        F.col("score").alias("negative_score"))
    named = banded.select(F.col("r").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return positives.join(negatives, ["anchor", "positive_score"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_four_russians_negatives(spark, sf_dir) -> DataFrame:
    return mine(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH t AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id,
    CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM t a JOIN t c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
