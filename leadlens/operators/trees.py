"""Regression trees and boosted trees from histograms of the sparse design.

A row is its numeric columns, as bins of at most ``BINS`` ranges, and one
feature number per category column.  Growing a level takes one pass: a task adds
up the number and the sum of its rows per (node, column, bin or feature number),
the tasks' cells are added up, and a dummy's rows without the level are the
node's rows less the cell.  A row costs its columns, not the dummies of all
levels (Spark's own trees hold a row as one number per feature).  Many cells are
added up by a shuffle, which hands the driver the numeric ones and one best dummy
per node and column; few go to the driver at once.

The rules are those of Spark's learner: thresholds midway between values, at
ranks of all training rows or of a sample of some 10,000; variance gain; the
first best feature and threshold; the first boosted tree is fitted to the label
with weight 1, the others to twice the error with the step as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise, shuffles_freed
from .knn import _matrix

BINS = 64
SAMPLE = 10_000              # rows that thresholds are taken from, at least
REWRITE = 10                 # boosted trees after which the rows' errors are written
FEW_ROWS, ROWS = 20_000, 500_000     # of a partition, while there are cores left and at most
DRIVER_CELLS = 1 << 19       # cells of all tasks that are added up in the driver; more are shuffled
CELLS = 1 << 22              # dummy cells that a task holds; beyond, it sends a batch's
EPSILON = 2.0 ** -52         # gains up to this are none
CELL = pa.schema([("node", pa.int32()), ("col", pa.int32()), ("value", pa.int32()), ("n", pa.int64()), ("s", pa.float64()),
                  ("all_n", pa.int64()), ("all_s", pa.float64())])
CELL_DDL = "node int, col int, value int, n long, s double, all_n long, all_s double"


@dataclass
class Tree:
    """Nodes by depth; ``left`` is the left child (-1: leaf), the right one
    comes next.  A row goes right if its bin is above ``cut``, or, on a category
    column (``hot``), if its feature number is ``cut``."""

    count: np.ndarray
    total: np.ndarray
    depth: int = 0
    col: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    hot: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=bool))
    left: np.ndarray = field(default_factory=lambda: np.full(1, -1, dtype=np.int32))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @property
    def value(self) -> np.ndarray:
        return self.total / self.count

    def walk(self, x: np.ndarray, root: int = 0) -> np.ndarray:
        """The leaf of each row of the columns ``x``, from ``root`` down."""
        at, rows = np.full(len(x), root, dtype=np.int32), np.arange(len(x))
        for _ in range(self.depth):
            v, cut, left = x[rows, self.col[at]], self.cut[at], self.left[at]
            at = np.where(left < 0, at, left + np.where(self.hot[at], v == cut, v > cut))
        return at

    def split(self, node, col, cut, hot, gain, n, total) -> np.ndarray:
        """Splits the nodes ``node``; ``n`` and ``total`` are the rows and sums of
        their left sides.  The new nodes, two by two."""
        at, made = len(self.left), 2 * len(node)
        for name, fill in (("col", 0), ("cut", 0), ("hot", False), ("left", -1), ("gain", 0.0), ("count", 0), ("total", 0.0)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, np.full(made, fill, dtype=old.dtype)]))
        node, lo = np.asarray(node), np.arange(at, at + made, 2)
        self.col[node], self.cut[node], self.hot[node], self.gain[node], self.left[node] = col, cut, hot, gain, lo
        self.count[lo], self.total[lo] = n, total
        self.count[lo + 1], self.total[lo + 1] = self.count[node] - self.count[lo], self.total[node] - self.total[lo]
        self.depth += 1
        return np.arange(at, at + made)

    def preorder(self) -> np.ndarray:
        out, todo = [], [0]
        while todo:
            out.append(todo.pop())
            if self.left[out[-1]] >= 0:
                todo += [int(self.left[out[-1]]) + 1, int(self.left[out[-1]])]
        return np.array(out)


# ---- thresholds and binned rows ------------------------------------------------

def thresholds_of(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds midway between neighbouring values, near equal
    shares of the rows."""
    v, n = np.unique(values, return_counts=True)
    mid = (v[:-1] + v[1:]) / 2
    if len(mid) <= most:
        return mid
    stride, out = len(values) / (most + 1), []
    target, seen = stride, np.cumsum(n)
    for i in range(1, len(v)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


def find_thresholds(train: DataFrame, n: int, key: str, seed: int) -> list[np.ndarray]:
    """Thresholds per numeric column, of all rows or of a sample of them."""
    bins = min(BINS, n)
    share = max(bins * bins, SAMPLE) / n
    if share < 1:
        train = train.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    dense = _matrix(train.select("dense").toArrow(), "dense", np.float64)
    return [thresholds_of(dense[:, j], bins - 1) for j in range(dense.shape[1])]


def columns(dense: np.ndarray, codes: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bins of the numeric columns, then the feature numbers."""
    return np.column_stack([*(np.searchsorted(t, dense[:, j]) for j, t in enumerate(thresholds)), codes]).astype(np.int32)


def binned(train: DataFrame, n: int, thresholds: list[np.ndarray], mean: float, ids: Column | None = None) -> DataFrame:
    """(x, e): the columns of a row as bytes, and the label less ``mean``; with
    ``ids`` also their value as h."""
    also = [] if ids is None else ["h"]

    def run(batches):
        for b in batches:
            if b.num_rows:
                dense = _matrix(b, "dense", np.float64)
                if not np.isfinite(dense).all():
                    raise ValueError("features of training rows must be finite")
                x = columns(dense, _matrix(b, "codes", np.int64), thresholds)
                yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()),
                                       pa.array(b.column("label").to_numpy() - mean), *(b.column(c) for c in also)],
                                      names=["x", "e", *also])
    spread = train.select("label", "dense", "codes", *(ids.alias(c) for c in also)).repartition(
        max(min(train.sparkSession.sparkContext.defaultParallelism, -(-n // FEW_ROWS)), -(-n // ROWS)))
    return materialise(spread.mapInArrow(run, "x binary, e double" + ", h long" * len(also)), "binned")


def _read_x(batch: pa.RecordBatch) -> np.ndarray:
    raw = batch.column("x")
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset:raw.offset + len(raw) + 1]
    x = np.frombuffer(raw.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].view(np.int32)
    return x.reshape(len(raw), -1)


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The columns and errors of binned rows."""
    return _read_x(batch), batch.column("e").to_numpy(zero_copy_only=False)


def _less(x: np.ndarray, e: np.ndarray, trees: list[tuple[float, Tree]]) -> np.ndarray:
    for weight, t in trees:
        e = e - weight * t.value[t.walk(x)]
    return e


# ---- growing -----------------------------------------------------------------

def _cells(rows: DataFrame, trees: list[tuple[float, Tree]], scale: float, tree: Tree, active: np.ndarray,
           numeric: int, width: int):
    """The cells of the active nodes of ``tree``, for ``scale`` times the errors
    left by ``trees``."""
    slot = np.full(len(tree.left), -1, dtype=np.int64)
    slot[active] = np.arange(len(active))
    k, few = len(active), len(active) * width <= CELLS

    def batch_of(key, n, s, by, base):
        node, rest = np.divmod(key, by)
        col, value = (np.divmod(rest, BINS) if base is None else (base, rest))
        at = active[node]
        return pa.record_batch([pa.array(np.broadcast_to(c, len(key)).astype(t.type.to_pandas_dtype())) for c, t in zip(
            (at, col, value, n, s, tree.count[at], tree.total[at]), CELL)], schema=CELL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k * numeric * BINS, dtype=np.int64), np.zeros(k * numeric * BINS)
        hot: dict[int, list[np.ndarray]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x, e = _read(b)
            r = scale * _less(x, e, trees)
            node = slot[tree.walk(x)]
            x, r, node = (a[node >= 0] for a in (x, r, node))
            if not len(r):
                continue
            key = ((node[:, None] * numeric + np.arange(numeric)) * BINS + x[:, :numeric]).ravel()
            n += np.bincount(key, minlength=len(n))
            s += np.bincount(key, np.repeat(r, numeric), minlength=len(s))
            for c in range(numeric, x.shape[1]):
                has = x[:, c] >= 0
                key, rh = node[has] * width + x[has, c], r[has]
                if few:
                    a = hot.setdefault(c, [np.zeros(k * width, dtype=np.int64), np.zeros(k * width)])
                    a[0] += np.bincount(key, minlength=k * width)
                    a[1] += np.bincount(key, rh, minlength=k * width)
                else:
                    key, place = np.unique(key, return_inverse=True)
                    yield batch_of(key, np.bincount(place), np.bincount(place, rh), width, c)
        for c, (hn, hs) in [(None, (n, s)), *hot.items()]:
            key = np.flatnonzero(hn)
            yield batch_of(key, hn[key], hs[key], numeric * BINS if c is None else width, c)

    return rows.mapInArrow(run, CELL_DDL)


def _best_cells(parts: DataFrame, numeric: int, min_rows: int) -> pa.Table:
    """The summed cells of the numeric columns, and of each category column and
    node that of the best dummy, the first among equals."""
    cells = parts.groupBy("node", "col", "value", "all_n", "all_s").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rest = F.col("all_n") - F.col("n")
    apart = F.col("s") / F.col("n") - F.try_divide(F.col("all_s") - F.col("s"), rest)
    gain = F.col("n") * rest.cast("double") / F.col("all_n") / F.col("all_n") * apart * apart
    rank = F.when(F.col("col") < numeric, 0.0).when(
        (F.col("n") >= min_rows) & (rest >= min_rows), F.format_string("%.10e", gain).cast("double")).otherwise(-1.0)
    return (cells.select("node", "col", F.when(F.col("col") < numeric, F.col("value")).otherwise(-1).alias("part"),
                         F.struct(rank.alias("g"), (-F.col("value")).alias("v"), "n", "s").alias("c"))
            .groupBy("node", "col", "part").agg(F.max("c").alias("c"))
            .select("node", "col", F.col("c.g").alias("g"), (-F.col("c.v")).alias("value"), F.col("c.n").alias("n"),
                    F.col("c.s").alias("s")).toArrow())


def _summed(cells: pa.Table) -> pa.Table:
    """The cells of all tasks, added up."""
    return cells.group_by(["node", "col", "value"], use_threads=False).aggregate([("n", "sum"), ("s", "sum")]).rename_columns(
        ["node", "col", "value", "n", "s"])


def _gain(n, s, all_n, all_s, min_rows):
    """Variance gain to ten digits (so that equal splits are equal whatever the
    order of their sums), -1 where a side has too few rows."""
    rest = all_n - n
    with np.errstate(divide="ignore", invalid="ignore"):
        g = n / all_n * rest / all_n * (s / n - (all_s - s) / rest) ** 2
        unit = 10.0 ** (np.floor(np.log10(g)) - 10)
        g = np.where(g > 0, np.round(g / unit) * unit, 0.0)
    return np.where((n >= min_rows) & (rest >= min_rows), g, -1.0)


def _splits(cells: pa.Table, tree: Tree, active: np.ndarray, numeric: int, min_rows: int):
    """(node, col, cut, hot, gain, rows and sum of the left side) of each active
    node that is split."""
    c = {name: cells.column(name).to_numpy() for name in ("node", "col", "value", "n", "s")}
    slot = np.searchsorted(active, c["node"])
    plain = c["col"] < numeric
    n, s = np.zeros((len(active), numeric, BINS)), np.zeros((len(active), numeric, BINS))
    n[slot[plain], c["col"][plain], c["value"][plain]] = c["n"][plain]
    s[slot[plain], c["col"][plain], c["value"][plain]] = c["s"][plain]
    n, s = np.cumsum(n, axis=2), np.cumsum(s, axis=2)
    for k, v in enumerate(active.tolist()):
        all_n, all_s = float(tree.count[v]), float(tree.total[v])
        best = (EPSILON,)
        if numeric:
            g = _gain(n[k], s[k], all_n, all_s, min_rows)
            at = int(np.argmax(g))
            if g.flat[at] > best[0]:
                best = (g.flat[at], at // BINS, at % BINS, False, n[k].flat[at], s[k].flat[at])
        hot = np.flatnonzero(~plain & (slot == k))
        hot = hot[np.argsort(c["value"][hot])]
        g = _gain(c["n"][hot], c["s"][hot], all_n, all_s, min_rows)
        if len(g) and g.max() > best[0]:
            i = hot[np.argmax(g)]
            best = (g.max(), int(c["col"][i]), int(c["value"][i]), True, all_n - c["n"][i], all_s - c["s"][i])
        if len(best) > 1:
            yield v, *best[1:4], best[0], *best[4:]


def grow(rows: DataFrame, trees: list[tuple[float, Tree]], scale: float, count: int, total: float, numeric: int,
         width: int, max_depth: int, min_rows: int = 1) -> Tree:
    """One tree for ``scale`` times the errors that ``trees`` leave; ``count`` and
    ``total`` are the number and sum of those."""
    t = Tree(np.array([count]), np.array([total]))
    active = np.array([0])
    tasks = rows.rdd.getNumPartitions()
    for _ in range(max_depth):
        parts = _cells(rows, trees, scale, t, active, numeric, width)
        few = tasks * len(active) * (numeric * BINS + width) <= DRIVER_CELLS
        with shuffles_freed(rows.sparkSession):
            cells = _summed(parts.toArrow()) if few else _best_cells(parts, numeric, min_rows)
        found = list(_splits(cells, t, active, numeric, min_rows))
        if not found:
            break
        active = t.split(*zip(*found))
        active = active[t.count[active] >= max(2, 2 * min_rows)]
        if not len(active):
            break
    return t


# ---- models --------------------------------------------------------------------

@dataclass
class TreeModel:
    """``trees`` with their weights; a prediction is ``base`` plus their sum."""

    trees: list[tuple[float, Tree]]
    thresholds: list[np.ndarray]
    base: float
    width: int
    max_depth: int

    def getMaxDepth(self) -> int:  # noqa: N802 - as Spark's models
        return self.max_depth

    def _feature(self, t: Tree) -> np.ndarray:
        return np.where(t.hot, t.cut, t.col)

    @property
    def featureImportances(self) -> SparseVector:  # noqa: N802 - as Spark's models
        """Gains weighted by rows, as shares of all."""
        out: dict[int, float] = {}
        for _, t in self.trees:
            inner = np.flatnonzero(t.left >= 0)
            for f, g in zip(self._feature(t)[inner].tolist(), (t.gain * t.count)[inner].tolist()):
                out[f] = out.get(f, 0.0) + g
        whole = sum(out.values())
        return Vectors.sparse(self.width, {f: g / whole for f, g in sorted(out.items())})

    def nodes(self, spark) -> DataFrame:
        """The node table of a single tree; ids are in pre-order."""
        t = self.trees[0][1]
        order = t.preorder()
        place = {int(v): i for i, v in enumerate(order)}
        rows = []
        for i, v in enumerate(order.tolist()):
            lo, f = int(t.left[v]), int(self._feature(t)[v])
            inner = lo >= 0
            cut = 0.5 if t.hot[v] else float(self.thresholds[t.col[v]][t.cut[v]]) if inner else None
            rows.append((i, self.base + float(t.value[v]), int(t.count[v]), float(t.gain[v]) if inner else -1.0,
                         place[lo] if inner else -1, place[lo + 1] if inner else -1, f if inner else -1, cut))
        return spark.createDataFrame(rows, "id int, prediction double, count long, gain double, left int, right int, "
                                           "feature int, threshold double")

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows of a design, without its vectors, with ``prediction`` and
        ``leaf`` (of the first tree, leaves numbered in pre-order)."""
        kept = [c for c in rows.columns if c not in ("features", "dense", "codes")]
        first = self.trees[0][1]
        order = first.preorder()
        leaf = np.zeros(len(first.left))
        leaf[order] = np.cumsum(first.left[order] < 0) - 1.0

        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = columns(_matrix(b, "dense", np.float64), _matrix(b, "codes", np.int64), self.thresholds)
                    told = self.base - _less(x, np.zeros(len(x)), self.trees)
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(told), pa.array(leaf[first.walk(x)])],
                                                     names=[*kept, "prediction", "leaf"])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
        return rows.select(*kept, "dense", "codes").mapInArrow(run, f"{ddl}, prediction double, leaf double")


def labels_of(train: DataFrame):
    """The number of rows and the mean label."""
    st = train.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"),
                   F.count_if(F.col("label").isNull() | F.isnan("label")).alias("bad")).first()
    if not st.n or st.bad:
        raise ValueError("training needs rows, and a label in each")
    return st


def fit(train: DataFrame, width: int, max_depth: int, rounds: int = 1, step: float = 1.0, min_rows: int = 1,
        key: str = "sku", seed: int = 42) -> TreeModel:
    """A tree, or ``rounds`` boosted trees, on the rows of a design."""
    st = labels_of(train)
    thresholds = find_thresholds(train, st.n, key, seed)
    numeric = len(thresholds)
    rows = binned(train, st.n, thresholds, st.mean)
    total = rows.agg(F.sum("e")).first()[0]
    trees, written = [], 0
    for m in range(rounds):
        t = grow(rows, trees[written:], 1.0 if m == 0 else 2.0, st.n, total, numeric, width, max_depth, min_rows)
        weight = 1.0 if m == 0 else step
        trees.append((weight, t))
        # twice the errors that are left, by the sums of the tree's leaves
        ends = t.total[t.left < 0].sum()
        total = 2 * ends * (1 - weight) if m == 0 else ends * (1 - 2 * weight)
        if m + 1 - written >= REWRITE and m + 1 < rounds:
            before, rows = rows, materialise(_with_errors(rows, trees[written:]), "boosted")
            discard(before)
            written = m + 1
    discard(rows)
    return TreeModel(trees, thresholds, st.mean, width, max_depth)


def _with_errors(rows: DataFrame, trees: list[tuple[float, Tree]]) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.record_batch([b.column("x"), pa.array(_less(*_read(b), trees))], names=["x", "e"])
    return rows.mapInArrow(run, "x binary, e double")
