"""Random forests on the sparse design rows.

Every tree is grown on a bag of the training rows: a row is drawn a Poisson(1)
number of times, told by its key's hash and the tree's number.  All trees share
the passes of the upper levels, which add up cells as ``trees`` does.  A node of
few rows is a unit: its rows go to one task, which grows the rest of the tree
below it, and what a task holds is bounded by ``UNIT_ROWS``.  The rows that a
level reads are those of the bags, so the work grows as rows times depth.  Units
are dealt by groups of trees, one after the other, so that only a group's rows
lie in shuffle files.

The forest is a table of units, each a record with its nodes; the driver holds the upper levels
only.  To be scored, rows go down the upper levels and then to their units.
The rules are those of Spark's learner, see ``trees``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise, materialise_parts, shuffles_freed, with_value
from . import trees as T
from .knn import _matrix
from .trees import BINS, EPSILON, Tree

UNIT_ROWS = 50_000           # drawn rows of a node that one task grows to the end
GROUP_ROWS = 5_000_000       # drawn rows of the trees whose units are dealt at a time, as long as
MOST_GROUPS = 10             # there are no more groups of trees than this
UNIT_IDS = 1 << 17           # more than the nodes below a node of UNIT_ROWS rows
PASS_NODES = 1_024           # nodes whose cells are added up in one pass
TIE = 1e-10                  # gains as near as this are equal, the first feature is taken
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 20)]))
NODE_DDL = ("unit int, tree int, id long, left long, right long, feature int, threshold double, value double, cover double, "
            "col int, cut int, hot boolean")
UNIT_DDL = "unit int, tree int, nodes int, split binary, col binary, cut binary, mean binary, rows binary"


def bag(ids: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    z = ids.astype(np.int64).view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return np.searchsorted(POISSON, (z >> np.uint64(11)) * 2.0 ** -53, side="right")


# ---- the levels of one task ------------------------------------------------------

def grow_unit(x: np.ndarray, e: np.ndarray, w: np.ndarray, numeric: int, depth: int, min_rows: int = 1) -> Tree:
    """The tree below a node with the rows ``x`` (rows by columns), errors ``e``
    and draws ``w``; all nodes of a level at once."""
    w = w.astype(np.float64)
    t = Tree(np.array([int(w.sum())]), np.array([(w * e).sum()]))
    x, levels = np.array(x.T, order="C"), {}
    for j in range(numeric, len(x)):
        levels[j], x[j] = np.unique(x[j], return_inverse=True)      # places among the unit's levels
    slot, active = np.zeros(len(w), dtype=np.int64), np.array([0])
    for _ in range(depth):
        if not len(active):
            break
        k = len(active)
        all_n, mean = t.count[active].astype(np.float64), t.value[active]
        y = w * (e - mean[slot])                # so that sums are as exact as a node's errors are near each other
        gain, col, cut = np.full(k, EPSILON), np.full(k, -1), np.zeros(k, dtype=np.int64)
        left_n, left_s = np.zeros(k), np.zeros(k)
        for j in range(len(x)):
            size = BINS if j < numeric else len(levels[j])
            if j >= numeric and levels[j][0] < 0:
                has = np.flatnonzero(x[j])                          # place 0: no level
                key, wj, yj = slot[has] * size + x[j, has], w[has], y[has]
            else:
                key, wj, yj = slot * size + x[j], w, y
            if not len(key):
                continue
            if k * size < 1 << 31:
                key = key.astype(np.int32)
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n, s = np.add.reduceat(wj[order], first), np.add.reduceat(yj[order], first)
            node, value = np.divmod(key[first], size)
            new = np.concatenate([[True], node[1:] != node[:-1]])
            start, part = np.flatnonzero(new), np.cumsum(new) - 1
            if j < numeric:                                         # sides up to a bin
                n_to, s_to = np.cumsum(n), np.cumsum(s)
                n, s = n_to - (n_to - n)[start][part], s_to - (s_to - s)[start][part]
            an = all_n[node]
            rest = an - n
            with np.errstate(divide="ignore", invalid="ignore"):
                g = n / an * rest / an * (s / n + s / rest) ** 2
            g = np.where((n >= min_rows) & (rest >= min_rows), g, -1.0)
            top = np.maximum.reduceat(g, start)
            better = top > gain[node[start]] * (1 + TIE)
            near = np.flatnonzero((g >= top[part] * (1 - TIE)) & better[part])
            if not len(near):
                continue
            at = near[np.concatenate([[True], part[near[1:]] != part[near[:-1]]])]
            v = node[at]
            gain[v], col[v], cut[v] = g[at], j, value[at]
            plain = j < numeric
            left_n[v], left_s[v] = (n[at], s[at]) if plain else (rest[at], -s[at])
        done = np.flatnonzero(col >= 0)
        if not len(done):
            break
        hot = col >= numeric
        made = t.split(active[done], col[done], np.array(
            [levels[c][v] if c in levels else v for c, v in zip(col[done].tolist(), cut[done].tolist())]), hot[done],
            gain[done], left_n[done], left_s[done] + left_n[done] * mean[done])
        rank = np.full(k, -1)
        rank[done] = np.arange(len(done))
        value = x[np.maximum(col, 0)[slot], np.arange(len(slot))]
        right = np.where(hot[slot], value == cut[slot], value > cut[slot])
        child = 2 * rank[slot] + right
        goes_on = t.count[made] >= max(2, 2 * min_rows)
        keep = (rank[slot] >= 0) & goes_on[child]
        place = np.cumsum(goes_on) - 1
        slot, x, w, e = place[child[keep]], x[:, keep], w[keep], e[keep]
        active = made[goes_on]
    return t


def _grow_units(dealt: DataFrame, top: Tree, tree_of: np.ndarray, units: np.ndarray, count: int, depth_of: np.ndarray,
                numeric: int, max_depth: int, min_rows: int) -> DataFrame:
    """The trees below the dealt units (``count`` of them), a record each."""

    def run(rows: pa.Table) -> pa.Table:
        unit = rows.column("unit")[0].as_py()
        e, w = (np.frombuffer(b"".join(rows.column(c).to_pylist()), dtype=d) for c, d in (("e", np.float64), ("w", np.uint8)))
        v = int(units[unit])
        t = grow_unit(_unpacked(rows, len(e)), e, w, numeric, max_depth - int(depth_of[v]), min_rows)
        return _packed_tree(t, unit, int(tree_of[v]))

    return _by_unit(dealt, count).groupBy("unit").applyInArrow(run, UNIT_DDL)


def _packed(x: np.ndarray, numeric: int) -> tuple[bytes, bytes]:
    """Columns of rows: a byte for a bin, four for a feature number."""
    return x[:, :numeric].astype(np.uint8).tobytes(), x[:, numeric:].tobytes()


def _unpacked(rows: pa.Table, n: int) -> np.ndarray:
    """The columns of the ``n`` rows of records with ``_packed`` rows."""
    parts = [[np.frombuffer(r, dtype=d) for r in rows.column(c).to_pylist() if r] for c, d in (("b", np.uint8), ("c", np.int32))]
    return np.concatenate([np.concatenate(p or [np.zeros(0)]).astype(np.int32).reshape(n, -1) for p in parts], axis=1)


def _packed_tree(t: Tree, unit: int, tree: int) -> pa.Table:
    """A tree as one record: which nodes are split (their children are numbered in
    that order), by what, and the mean and rows of the leaves."""
    inner = t.left >= 0
    if not np.array_equal(t.left[inner], 1 + 2 * np.arange(inner.sum())):
        raise ValueError("children must be numbered in the order of their parents")
    n = np.maximum(t.count[~inner], 1)
    parts = (np.packbits(inner), t.col[inner].astype(np.int32), t.cut[inner].astype(np.int32), t.total[~inner] / n, n.astype(np.int32))
    return pa.table([pa.array([unit], pa.int32()), pa.array([tree], pa.int32()), pa.array([len(inner)], pa.int32()),
                     *(pa.array([p.tobytes()], pa.binary()) for p in parts)], names=[c.split()[0] for c in UNIT_DDL.split(", ")])


def _tree_of(r: dict, numeric: int) -> Tree:
    """The tree of a ``_packed_tree`` record."""
    inner = np.unpackbits(np.frombuffer(r["split"], dtype=np.uint8), count=r["nodes"]).astype(bool)
    t = Tree(np.zeros(len(inner), dtype=np.int64), np.zeros(len(inner)))
    t.left, t.col, t.cut = (np.full(len(inner), k, dtype=np.int32) for k in (-1, 0, 0))
    t.left[inner] = 1 + 2 * np.arange(inner.sum())
    t.col[inner], t.cut[inner] = (np.frombuffer(r[c], dtype=np.int32) for c in ("col", "cut"))
    t.hot = inner & (t.col >= numeric)
    t.count[~inner] = np.frombuffer(r["rows"], dtype=np.int32)
    t.total[~inner] = np.frombuffer(r["mean"]) * t.count[~inner]
    levels = [np.array([0])]
    while len(v := levels[-1][t.left[levels[-1]] >= 0]):
        levels.append(np.concatenate([t.left[v], t.left[v] + 1]))
    for level in levels[::-1]:
        v = level[t.left[level] >= 0]
        t.count[v] = t.count[t.left[v]] + t.count[t.left[v] + 1]
        t.total[v] = t.total[t.left[v]] + t.total[t.left[v] + 1]
    t.depth = len(levels) - 1
    return t


def _by_unit(df: DataFrame, units: int) -> DataFrame:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(_tasks(cores, units), "unit")


def _tasks(cores: int, units: int) -> int:
    return max(1, min(units, max(4 * cores, units // 16)))


def _node_rows(t: Tree, unit: int, tree: np.ndarray, root: int, offset: int, thresholds: list[np.ndarray], base: float) -> pa.Table:
    """Nodes as rows of the forest's table; node 0 is ``root``, the others are
    numbered from ``offset``."""
    n, inner = len(t.left), t.left >= 0
    ids = offset + np.arange(n)
    if root >= 0:
        ids[0] = root
    side = lambda more: np.where(inner, offset + t.left + more, -1)
    cut = np.array([0.5 if h else float(thresholds[c][v]) if i else 0.0
                    for i, h, c, v in zip(inner.tolist(), t.hot.tolist(), t.col.tolist(), t.cut.tolist())])
    value = base + t.total / np.maximum(t.count, 1)
    found = [np.full(n, unit), tree, ids, side(0), side(1), np.where(inner, np.where(t.hot, t.cut, t.col), -1), cut, value,
             np.maximum(t.count, 1), t.col, t.cut, t.hot]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(),
             pa.int32(), pa.int32(), pa.bool_()]
    names = [c.split()[0] for c in NODE_DDL.split(", ")]
    return pa.table([pa.array(a.astype(k.to_pandas_dtype()), k) for a, k in zip(found, kinds)], names=names)


# ---- the levels that all tasks share -----------------------------------------------

def _upper_cells(rows: DataFrame, top: Tree, tree_of: np.ndarray, active: np.ndarray, numeric: int) -> DataFrame:
    """The cells of the active nodes, of all trees."""
    slot = np.full(len(top.left), -1, dtype=np.int64)
    slot[active] = np.arange(len(active))
    size = max(1, numeric) * BINS
    some = np.unique(tree_of[active]).tolist()

    def batch_of(node, col, value, n, s):
        at = active[node]
        return pa.record_batch([pa.array(np.broadcast_to(c, len(node)).astype(f.type.to_pandas_dtype())) for c, f in zip(
            (at, col, value, n, s, top.count[at], top.total[at]), T.CELL)], schema=T.CELL)

    def run(batches):
        n, s = np.zeros(len(active) * size), np.zeros(len(active) * size)
        for b in batches:
            if not b.num_rows:
                continue
            x, e = T._read(b)
            h = b.column("h").to_numpy()
            drawn = []
            for t in some:
                w = bag(h, t)
                r = np.flatnonzero(w)
                node = slot[top.walk(x[r], t)]
                drawn.append((r[node >= 0], node[node >= 0], w[r[node >= 0]]))
            r, node, w = (np.concatenate(a) for a in zip(*drawn))
            y = w * e[r]
            for j in range(numeric):
                key = node * size + j * BINS + x[r, j]
                n += np.bincount(key, w, minlength=len(n))
                s += np.bincount(key, y, minlength=len(s))
            for j in range(numeric, x.shape[1]):
                has = np.flatnonzero(x[r, j] >= 0)
                if len(has):
                    values, place = np.unique(x[r[has], j], return_inverse=True)
                    key, at = np.unique(node[has] * len(values) + place, return_inverse=True)
                    yield batch_of(key // len(values), j, values[key % len(values)], np.bincount(at, w[has]), np.bincount(at, y[has]))
        key = np.flatnonzero(n)
        if len(key):
            node, rest = np.divmod(key, size)
            yield batch_of(node, rest // BINS, rest % BINS, n[key], s[key])

    return rows.mapInArrow(run, T.CELL_DDL)


def _roots(rows: DataFrame, n_trees: int) -> Tree:
    """The roots of all trees: draws and sums of the bags."""
    def run(batches):
        n, s = np.zeros(n_trees, dtype=np.int64), np.zeros(n_trees)
        for b in batches:
            h, e = b.column("h").to_numpy(), b.column("e").to_numpy()
            for t in range(n_trees):
                w = bag(h, t)
                n[t] += w.sum()
                s[t] += (w * e).sum()
        yield pa.record_batch([pa.array(np.arange(n_trees, dtype=np.int32)), pa.array(n), pa.array(s)], names=["t", "n", "s"])
    got = rows.select("h", "e").mapInArrow(run, "t int, n long, s double").groupBy("t").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("t").collect()
    return Tree(np.array([r.n for r in got]), np.array([r.s for r in got]), 0, np.zeros(n_trees, dtype=np.int32),
                np.zeros(n_trees, dtype=np.int32), np.zeros(n_trees, dtype=bool), np.full(n_trees, -1, dtype=np.int32), np.zeros(n_trees))


def _dealt(rows: DataFrame, top: Tree, units: np.ndarray, trees: list[int], numeric: int) -> DataFrame:
    """The drawn rows of the units of some trees, many to a record."""
    slot = np.full(len(top.left), -1, dtype=np.int64)
    slot[units] = np.arange(len(units))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, e = T._read(b)
            h = b.column("h").to_numpy()
            for t in trees:
                w = bag(h, t)
                r = np.flatnonzero(w)
                found = list(_parts(slot[top.walk(x[r], t)]))
                if found:
                    packed = [_packed(x[r[i]], numeric) for _, i in found]
                    yield pa.record_batch([
                        pa.array([u for u, _ in found], pa.int32()), *(pa.array(p, pa.binary()) for p in zip(*packed)),
                        pa.array([e[r[i]].tobytes() for _, i in found], pa.binary()),
                        pa.array([w[r[i]].astype(np.uint8).tobytes() for _, i in found], pa.binary())], names=["unit", "b", "c", "e", "w"])

    return rows.mapInArrow(run, "unit int, b binary, c binary, e binary, w binary")


def _parts(unit: np.ndarray):
    """(unit, its places) of each unit but -1."""
    order = np.argsort(unit, kind="stable")
    of, starts = np.unique(unit[order], return_index=True)
    for u, places in zip(of.tolist(), np.split(order, starts[1:])):
        if u >= 0:
            yield u, places


# ---- model ---------------------------------------------------------------------

@dataclass
class ForestModel:
    """``top``: the upper levels, tree t from node t; ``units``: the nodes of
    ``top`` that go on in the table ``below``, which is written by group of trees
    (tree t is in group t modulo ``groups``)."""

    top: Tree
    tree_of: np.ndarray
    n_trees: int
    units: np.ndarray
    below: DataFrame
    thresholds: list[np.ndarray]
    base: float
    width: int
    groups: int = 1

    def node_table(self, spark) -> DataFrame:
        """(tree, id, left, right, feature, threshold, value, cover)."""
        upper = np.setdiff1d(np.arange(len(self.top.left)), self.units)
        rows = _node_rows(self.top, -1, self.tree_of, -1, 0, self.thresholds, self.base).take(pa.array(upper))
        n_top, units, thresholds, base = len(self.top.left), self.units, self.thresholds, self.base

        def expand(batches):
            for b in batches:
                for r in b.to_pylist():
                    t = _tree_of(r, len(thresholds))
                    yield from _node_rows(t, r["unit"], np.full(len(t.left), r["tree"]), int(units[r["unit"]]),
                                          n_top + r["unit"] * UNIT_IDS, thresholds, base).to_batches()

        below = self.below.drop("part").mapInArrow(expand, NODE_DDL)
        out = spark.createDataFrame(rows.to_pylist(), NODE_DDL).unionByName(below)
        return out.select("tree", "id", "left", "right", "feature", "threshold", "value", "cover")

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows of a design, without its vectors, with ``prediction``."""
        kept = [c for c in rows.columns if c not in ("features", "dense", "codes")]
        top, n_trees, thresholds, numeric = self.top, self.n_trees, self.thresholds, len(self.thresholds)
        slot = np.full(len(top.left), -1, dtype=np.int64)
        slot[self.units] = np.arange(len(self.units))
        ended = np.where(slot < 0, top.total / np.maximum(top.count, 1), 0.0)

        def upper(batches):
            for b in batches:
                if b.num_rows:
                    x = T.columns(_matrix(b, "dense", np.float64), _matrix(b, "codes", np.int64), thresholds)
                    told = np.zeros(len(x))
                    for t in range(n_trees):
                        told += ended[top.walk(x, t)]
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c) for c in (*kept, "__r")), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(told)],
                        names=[*kept, "__r", "__x", "__told"])

        def deal(trees):
            def run(batches):
                for b in batches:
                    if not b.num_rows:
                        continue
                    x, r = T._read_x(b.rename_columns(["__r", "x"])), b.column("__r").to_numpy()
                    for t in trees:
                        found = list(_parts(slot[top.walk(x, t)]))
                        if found:
                            packed = [_packed(x[i], numeric) for _, i in found]
                            yield pa.record_batch([
                                pa.array([u for u, _ in found], pa.int32()), *(pa.array(p, pa.binary()) for p in zip(*packed)),
                                pa.array([r[i].tobytes() for _, i in found], pa.binary())], names=["unit", "b", "c", "r"])
            return run

        def score(some: pa.Table, unit: pa.Table) -> pa.Table:
            if not some.num_rows:
                return pa.table([pa.array([], pa.int64()), pa.array([], pa.float64())], names=["r", "v"])
            t = _tree_of(unit.to_pylist()[0], numeric)
            r = np.frombuffer(b"".join(some.column("r").to_pylist()), dtype=np.int64)
            x = _unpacked(some, len(r))
            at, on = np.zeros(len(r), dtype=np.int64), np.arange(len(r))
            while len(on := on[t.left[at[on]] >= 0]):
                v = at[on]
                value = x[on, t.col[v]]
                at[on] = t.left[v] + np.where(t.hot[v], value == t.cut[v], value > t.cut[v])
            return pa.table([pa.array(r), pa.array(t.total[at] / np.maximum(t.count[at], 1))], names=["r", "v"])

        base = self.base
        schema = rows.select(*kept).schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        told = materialise(rows.select(*kept, "dense", "codes").withColumn("__r", F.monotonically_increasing_id()).mapInArrow(
            upper, f"{ddl}{', ' if ddl else ''}__r long, __x binary, __told double"), "scored")
        of = self.tree_of[self.units] % self.groups

        def group_sums(g):
            trees, count = list(range(g, n_trees, self.groups)), int((of == g).sum())
            values = _by_unit(told.select("__r", "__x").mapInArrow(deal(trees), "unit int, b binary, c binary, r binary"), count)
            values = values.groupBy("unit").cogroup(_by_unit(with_value(self.below, "part", str(g)), count).groupBy("unit"))
            return values.applyInArrow(score, "r long, v double").groupBy(F.col("r").alias("__r")).agg(F.sum("v").alias("__v"))

        summed = materialise_parts(rows.sparkSession, (group_sums(g) for g in range(self.groups)), "forest-values").groupBy(
            "__r").agg(F.sum("__v").alias("__v"))
        return told.join(summed, "__r", "left").select(
            *kept, (F.lit(base) + (F.col("__told") + F.coalesce("__v", F.lit(0.0))) / n_trees).alias("prediction"))


def fit(train: DataFrame, width: int, n_trees: int, max_depth: int, min_rows: int = 1, key: str = "sku", seed: int = 42) -> ForestModel:
    """``n_trees`` trees, each on a bag of the rows of a design."""
    st = T.labels_of(train)
    thresholds = T.find_thresholds(train, st.n, key, seed)
    numeric = len(thresholds)
    rows = T.binned(train, st.n, thresholds, st.mean, F.xxhash64(F.col(key), F.lit(seed)))
    top = _roots(rows, n_trees)
    tree_of, depth_of = np.arange(n_trees), np.zeros(n_trees, dtype=np.int64)
    units, level = [np.arange(0)], np.arange(n_trees)
    for _ in range(max_depth):
        level = level[top.count[level] >= max(2, 2 * min_rows)]
        units.append(level[top.count[level] <= UNIT_ROWS])
        level = level[top.count[level] > UNIT_ROWS]
        if not len(level):
            break
        found = []
        for lo in range(0, len(level), PASS_NODES):
            some = level[lo:lo + PASS_NODES]
            with shuffles_freed(train.sparkSession):
                cells = T._best_cells(_upper_cells(rows, top, tree_of, some, numeric), numeric, min_rows)
            found += T._splits(cells, top, some, numeric, min_rows)
        if not found:
            break
        parents = np.array([f[0] for f in found])
        level = top.split(*zip(*found))
        tree_of = np.concatenate([tree_of, np.repeat(tree_of[parents], 2)])
        depth_of = np.concatenate([depth_of, np.repeat(depth_of[parents] + 1, 2)])
    units = np.concatenate(units)
    groups = max(1, min(MOST_GROUPS, n_trees, -(-int(top.count[:n_trees].sum()) // GROUP_ROWS)))
    of = tree_of[units] % groups

    def group(g):
        dealt = _dealt(rows, top, units, list(range(g, n_trees, groups)), numeric)
        return _grow_units(dealt, top, tree_of, units, int((of == g).sum()), depth_of, numeric, max_depth, min_rows).withColumn(
            "part", F.lit(g))

    below = materialise_parts(train.sparkSession, (group(g) for g in range(groups)), "forest-nodes", by="part")
    discard(rows)
    return ForestModel(top, tree_of, n_trees, units, below, thresholds, st.mean, width, groups)
