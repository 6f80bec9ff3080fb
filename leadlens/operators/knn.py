"""Exact k-nearest-neighbour regression (Euclidean, uniform weights) with a
space-partitioning tree.

1. A k-d tree over the training rows' vectors is grown from bounded samples:
   a cell with more than ``CELL_ROWS`` rows is sampled and split at the median
   of its widest coordinate, over and over, until no cell is too heavy or the
   tree has ``MAX_CELLS`` cells.  The tree, and each cell's row count and
   bounding box over all its rows, are the only things shared with all tasks.
2. Each query is compared with the rows of its own cell: the k-th distance
   there bounds its radius.  Where the cell holds fewer than k rows, the bound
   is the distance to the far corner of enough of the nearest boxes.
3. Each query then visits the other cells whose box is within its radius, found
   from the root down, so that it is compared with the boxes near it and not
   with all.  The k nearest rows of all cells (distance, then key) are kept.

A cell is compared in units of at most ``CELL_ROWS`` training rows and
``QUERY_ROWS`` queries, so a cell that the tree cannot split, and a cell that
many queries visit, are spread over tasks.  Rows with identical vectors are
cut to the k smallest keys first (only those can be chosen).  Category columns
enter as codes: two rows that differ there are apart by the number of their
dummies, as with drop-first dummies.  Ties go to the smaller training key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialise

CELL_ROWS = 2048             # training rows of a cell, and of a unit
QUERY_ROWS = 4096            # queries of a unit
MAX_CELLS = 4096             # the tree's size bound
SAMPLE_ROWS = 50_000         # rows that grow the tree in one round, at most about so many
DISTANCES = 1 << 21          # computed in one step
PAIRS = 1 << 13              # queries and tree nodes compared in one step


# ---- the tree ----------------------------------------------------------------

class Tree:
    """Inner nodes (coordinate, cut, children); leaves are cells."""

    def __init__(self, coordinate=(-1,), cut=(0.0,), left=(-1,), right=(-1,)):
        self.coordinate, self.cut, self.left, self.right = list(coordinate), list(cut), list(left), list(right)

    def cells(self) -> list[int]:
        return [k for k, c in enumerate(self.coordinate) if c < 0]

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row of ``x``."""
        at = np.zeros(len(x), dtype=np.int64)
        coordinate, cut, left, right = [np.array(v) for v in (self.coordinate, self.cut, self.left, self.right)]
        while True:
            inner = np.flatnonzero(coordinate[at] >= 0)
            if not len(inner):
                return at
            here = at[inner]
            at[inner] = np.where(x[inner, coordinate[here]] <= cut[here], left[here], right[here])

    def split(self, cell: int, x: np.ndarray, parts: int) -> None:
        """Split a cell at the median of its sample's widest coordinate, on
        until it is in ``parts`` or the sample does not tell its rows apart."""
        if parts < 2 or len(x) < 2:
            return
        for c in np.argsort(-x.var(axis=0), kind="stable"):
            cut = float(np.median(x[:, c]))
            if cut >= x[:, c].max():                     # half the sample is at the top: cut below it
                below = x[:, c][x[:, c] < cut]
                if not len(below):
                    continue
                cut = float(below.max())
            low = x[:, c] <= cut
            self.coordinate[cell], self.cut[cell] = int(c), cut
            for side, rows in ((self.left, low), (self.right, ~low)):
                side[cell] = len(self.coordinate)
                self.coordinate.append(-1)
                self.cut.append(0.0)
                self.left.append(-1)
                self.right.append(-1)
                self.split(side[cell], x[rows], -(-parts // 2))
            return


def _matrix(batch: pa.RecordBatch | pa.Table, col: str, kind: type) -> np.ndarray:
    lists = batch.column(col)
    flat = (pa.concat_arrays(x.flatten() for x in lists.chunks) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks
            else lists.flatten() if not isinstance(lists, pa.ChunkedArray) else pa.array([], pa.float64()))
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)


def _with_cells(rows: DataFrame, tree: Tree) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(tree.cell_of(_matrix(batch, "x", np.float64))))

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("cell", LongType())]))


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows of each cell; as many numbers as the tree has cells."""
    return {r.cell: r.n for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}


def grow(rows: DataFrame) -> Tree:
    """A tree whose cells hold at most CELL_ROWS rows, as far as its size
    bound and equal vectors allow."""
    tree = Tree()
    counts = {0: rows.count()}
    while True:
        heavy = {c: n for c, n in counts.items() if n > CELL_ROWS}
        room = MAX_CELLS - len(tree.cells())
        if not heavy or room <= 0:
            return tree
        placed = _with_cells(rows, tree).where(F.col("cell").isin(list(heavy)))
        share = min(1.0, SAMPLE_ROWS / sum(heavy.values()))
        sample = placed.select("cell", "x").sample(share, seed=len(tree.coordinate)).toArrow()
        cell, x = sample.column("cell").to_numpy(), _matrix(sample, "x", np.float64)
        before = len(tree.cells())
        for c, n in sorted(heavy.items(), key=lambda e: -e[1]):
            room = MAX_CELLS - len(tree.cells())
            # two more than needed at the mean, so that most need no other round
            tree.split(c, x[cell == c], min(room, 2 * n // CELL_ROWS + 1, max(1, int((cell == c).sum()) // 8)))
        if len(tree.cells()) == before:
            return tree
        counts = _counts(_with_cells(rows, tree))


def boxes(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, rows, low corner, high corner) over all rows of each cell."""
    x = [F.get("x", F.lit(i)) for i in range(dims)]
    got = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(c) for c in x]).alias("low"),
                                   F.array(*[F.max(c) for c in x]).alias("high")).collect()
    shape = (len(got), dims)
    return (np.array([r.cell for r in got], dtype=np.int64), np.array([r.n for r in got], dtype=np.int64),
            np.array([r.low for r in got], dtype=np.float64).reshape(shape),
            np.array([r.high for r in got], dtype=np.float64).reshape(shape))


# ---- comparing ---------------------------------------------------------------

def nearest(q: np.ndarray, q_codes: np.ndarray, t: np.ndarray, t_codes: np.ndarray, most: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of each query's first k rows by distance,
    then row, with a squared distance of at most ``most``."""
    out = []
    step = max(1, DISTANCES // max(1, len(t)))
    for lo in range(0, len(q), step):
        d2 = np.zeros((len(q[lo:lo + step]), len(t)))
        for c in range(q.shape[1]):
            gap = q[lo:lo + step, c, None] - t[None, :, c]
            d2 += gap * gap
        for c in range(q_codes.shape[1]):
            a, b = q_codes[lo:lo + step, c, None], t_codes[None, :, c]
            d2 += np.where(a != b, (a >= 0).astype(np.int64) + (b >= 0), 0)
        d2[~(d2 <= most[lo:lo + step, None])] = np.inf
        if len(t) > k:
            bar = np.partition(d2, k - 1, axis=1)[:, k - 1]
            inside = (d2 <= bar[:, None]) & np.isfinite(d2)
        else:
            inside = np.isfinite(d2)
        query, row = np.nonzero(inside)
        order = np.lexsort((row, d2[query, row], query))
        query, row = query[order], row[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < k
        query, row = query[first], row[first]
        out.append((query + lo, row, d2[query, row]))
    return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0) for i in range(3))


def _compare(train: DataFrame, query: DataFrame, k: int) -> DataFrame:
    """(q_key, t_key, t_label, d2): each query's first k rows in each unit of
    the cells it is sent to."""
    of_train = train.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("nt"))
    of_query = query.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("nq"))
    units = of_train.join(of_query, "cell")              # at most MAX_CELLS rows
    block = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    t = train.join(units, "cell").withColumn("tb", block("t_key", "nt")).withColumn("qb", every("nq"))
    q = query.join(units, "cell").withColumn("qb", block("q_key", "nq")).withColumn("tb", every("nt"))
    t = t.select(F.col("cell").alias("t_cell"), F.col("tb").alias("t_tb"), F.col("qb").alias("t_qb"), "t_key", "t_label",
                 F.col("x").alias("t_x"), F.col("codes").alias("t_codes"))
    q = q.select("cell", "tb", "qb", "q_key", "x", "codes", "most")
    kind = dict(train.dtypes)["t_key"], dict(query.dtypes)["q_key"]
    schema = f"q_key {kind[1]}, t_key {kind[0]}, t_label double, d2 double"

    def run(qs: pa.Table, ts: pa.Table) -> pa.Table:
        ts = ts.sort_by("t_key")
        a, b, d2 = nearest(_matrix(qs, "x", np.float64), _matrix(qs, "codes", np.int64), _matrix(ts, "t_x", np.float64),
                           _matrix(ts, "t_codes", np.int64), qs.column("most").to_numpy(), k) if ts.num_rows and qs.num_rows \
            else (np.zeros(0), np.zeros(0), np.zeros(0))
        a, b = pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))
        return pa.table([qs.column("q_key").take(a), ts.column("t_key").take(b), ts.column("t_label").take(b), pa.array(d2)],
                        names=["q_key", "t_key", "t_label", "d2"])

    return q.groupBy("cell", "tb", "qb").cogroup(t.groupBy("t_cell", "t_tb", "t_qb")).applyInArrow(run, schema)


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_key").orderBy("d2", "t_key")
    return pairs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def node_boxes(tree: Tree, box: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, low corner, high corner) of every node: a cell's own, an inner
    node's around those of its cells."""
    cells, n, low, high = box
    size = len(tree.coordinate)
    rows = np.zeros(size, dtype=np.int64)
    lows, highs = np.full((size, low.shape[1]), np.inf), np.full((size, low.shape[1]), -np.inf)
    rows[cells], lows[cells], highs[cells] = n, low, high
    for v in reversed(range(size)):                      # children come after their parent
        if tree.coordinate[v] >= 0:
            some = [c for c in (tree.left[v], tree.right[v]) if rows[c]]
            rows[v] = rows[some].sum()
            if some:                                     # a NaN hides its own cell alone
                lows[v], highs[v] = np.fmin.reduce(lows[some]), np.fmax.reduce(highs[some])
    return rows, lows, highs


def reached(tree: Tree, nodes: tuple, x: np.ndarray, r2: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, cell) arrays of the cells with rows whose box lies within a row's
    squared radius.  Each row goes down the tree from the root, past nodes whose
    box is out of its radius; ``PAIRS`` rows and nodes are looked at in a step."""
    rows, low, high = nodes
    coordinate, left, right = np.array(tree.coordinate), np.array(tree.left), np.array(tree.right)
    todo = [(np.arange(len(x)), np.zeros(len(x), dtype=np.int64))] if rows[0] else []
    while todo:
        row, node = todo.pop()
        if len(row) > PAIRS:
            todo.append((row[PAIRS:], node[PAIRS:]))
            row, node = row[:PAIRS], node[:PAIRS]
        at = x[row]
        near = (np.maximum(0, np.maximum(low[node] - at, at - high[node])) ** 2).sum(axis=1)
        inside = near <= r2[row]
        row, node = row[inside], node[inside]
        cell = coordinate[node] < 0
        if cell.any():
            yield row[cell], node[cell]
        row, node = row[~cell], node[~cell]
        if len(row):
            row, node = np.concatenate([row, row]), np.concatenate([left[node], right[node]])
            some = rows[node] > 0
            todo.append((row[some], node[some]))


def _visits(query: DataFrame, tree: Tree, box: tuple, categories: int, k: int) -> DataFrame:
    """A row for each query and other cell that may hold one of its k nearest
    rows; ``most`` becomes the squared radius."""
    _, n, low, high = box
    nodes = node_boxes(tree, box)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = _matrix(batch, "x", np.float64), batch.column("cell").to_numpy()
            r2 = batch.column("r2").to_numpy(zero_copy_only=False).copy()
            few = np.flatnonzero(np.isnan(r2))           # fewer than k rows in the own cell
            for lo in range(0, len(few), 64):
                at = x[few[lo:lo + 64], None, :]
                far = (np.maximum(np.abs(at - low), np.abs(high - at)) ** 2).sum(axis=2) + 2 * categories
                order = np.argsort(far, axis=1)
                enough = np.argmax(np.cumsum(n[order], axis=1) >= k, axis=1)
                bound = np.take_along_axis(far, order, axis=1)[np.arange(len(far)), enough]
                bound[n.sum() < k] = np.inf
                r2[few[lo:lo + 64]] = bound
            r2 = r2 * (1 + 1e-9) + 1e-12                 # the boxes' distances are rounded
            for row, cell in reached(tree, nodes, x, r2):
                other = cell != own[row]
                row, cell = row[other], cell[other]
                if not len(row):
                    continue
                some = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [some.column("q_key"), some.column("x"), some.column("codes"), pa.array(r2[row]), pa.array(cell)],
                    names=["q_key", "x", "codes", "most", "cell"])

    kind = dict(query.dtypes)["q_key"]
    return query.select("q_key", "x", "codes", "cell", F.coalesce("r2", F.lit(float("nan"))).alias("r2")).mapInArrow(
        run, f"q_key {kind}, x array<double>, codes array<int>, most double, cell long")


def knn_regress(train: DataFrame, query: DataFrame, features: list[str] | Column, k: int = 5, key: str = "sku",
                label: str = "label", codes: Column | None = None) -> DataFrame:
    """Prediction for every query row: mean label of its k nearest training
    rows (of all, if fewer).  ``features``: numeric columns, or one array
    column; ``codes``: an array column of category codes, -1 for none.
    Returns (key, prediction); a table without training rows predicts nothing."""
    x = F.array(*[F.col(c).cast("double") for c in features]) if isinstance(features, list) else features
    codes = F.array().cast("array<int>") if codes is None else codes
    t = train.select(F.col(key).alias("t_key"), F.col(label).cast("double").alias("t_label"), x.alias("x"), codes.alias("codes"))
    dup = Window.partitionBy("x", "codes").orderBy("t_key")
    t = materialise(t.withColumn("__d", F.row_number().over(dup)).where(F.col("__d") <= k).drop("__d"), "knn-train")
    first = t.first()
    if first is None:
        return query.select(key, F.lit(None).cast("double").alias("prediction")).where("false")
    tree = grow(t.select("x"))
    t = materialise(_with_cells(t, tree), "knn-cells")
    box = boxes(t, len(first.x))
    q = query.select(F.col(key).alias("q_key"), x.alias("x"), codes.alias("codes"))
    q = materialise(_with_cells(q, tree), "knn-queries")

    own = materialise(_top_k(_compare(t, q.withColumn("most", F.lit(float("inf"))), k), k), "knn-own")
    bound = own.groupBy("q_key").agg(F.when(F.count(F.lit(1)) >= k, F.max("d2")).alias("r2"))
    visits = materialise(_visits(q.join(bound, "q_key", "left"), tree, box, len(first.codes), k), "knn-visits")
    nn = _top_k(own.unionByName(_compare(t, visits, k)), k)
    return nn.groupBy("q_key").agg(F.avg("t_label").alias("prediction")).withColumnRenamed("q_key", key)


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """RMSE, R² (1 - SS_res / SS_tot about the group's own mean) and MAE per
    group, from one aggregate with an exact two-pass-free formula."""
    by = by or []
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    g = pred.groupBy(*by) if by else pred
    out = g.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"),
                F.var_pop(y).alias("vy"))
    return out.select(*by, "n",
                      F.round(F.sqrt(F.col("sse") / F.col("n")), 6).alias("rmse"),
                      F.round(1 - F.try_divide(F.col("sse"), F.col("vy") * F.col("n")), 6).alias("r2"),
                      F.round(F.col("sae") / F.col("n"), 6).alias("mae"))
