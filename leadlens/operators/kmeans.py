"""Many k-means fits in one scan per iteration.

A Lloyd step updates the centres of all (k, seed) fits together: a task
compares its rows with every centre of every fit still moving and hands on one
row per centre (count, sums, cost), so an iteration scans the rows once,
however many fits there are.  What reaches the driver per iteration is one row
per centre: its size is that of the models.

Each fit starts with k-means++ over at most ``INIT_POINTS`` distinct points,
weighted by their copies; every step after that uses all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INIT_POINTS = 4096           # distinct points, in hash order, that the first centres are drawn from
CHUNK = 4096                 # rows compared at once in a task


@dataclass
class Fit:
    """``centres`` (k, d); ``inertia`` of each step's centres, the last one of
    ``centres``; ``counts``, ``sums`` and ``squares`` (sum of squared norms) of
    the rows nearest to each centre."""

    k: int
    seed: int
    centres: np.ndarray
    inertia: list[float] = field(default_factory=list)
    counts: np.ndarray | None = None
    sums: np.ndarray | None = None
    squares: np.ndarray | None = None


def first_centres(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over weighted points; all of them if there are no more than k."""
    if len(points) <= k:
        return points.copy()
    rng = np.random.default_rng([seed, k])
    at = [int(rng.choice(len(points), p=weight / weight.sum()))]
    near = ((points - points[at[0]]) ** 2).sum(axis=1)
    while len(at) < k:
        p = near * weight
        at.append(int(rng.choice(len(points), p=p / p.sum())))
        near = np.minimum(near, ((points - points[at[-1]]) ** 2).sum(axis=1))
    return points[at]


def _chunks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for at in range(0, len(x), CHUNK):
            yield x[at:at + CHUNK]


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :], 0)


def _step(points: DataFrame, d: int, fits: list[np.ndarray]) -> list:
    """(fit, centre, n, cost, squares, s0...) of all centres with rows."""
    names = ["n", "cost", "squares", *[f"s{i}" for i in range(d)]]
    stacked = np.concatenate(fits)
    edges = np.cumsum([0, *[len(c) for c in fits]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(stacked), 3 + d))
        for x in _chunks(batches, d):
            dist = squared_distances(x, stacked)
            row = np.column_stack([np.ones(len(x)), np.zeros(len(x)), (x * x).sum(axis=1), x])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = dist[:, a:b].argmin(axis=1)
                member = np.zeros((b - a, len(x)))
                member[own, np.arange(len(x))] = 1
                row[:, 1] = dist[np.arange(len(x)), a + own]
                total[a:b] += member @ row
        at = np.flatnonzero(total[:, 0])
        fit = np.searchsorted(edges, at, side="right") - 1
        yield pa.RecordBatch.from_pydict(
            {"fit": fit.astype(np.int32), "centre": (at - edges[fit]).astype(np.int32)}
            | {c: total[at, i] for i, c in enumerate(names)})

    parts = points.mapInArrow(run, "fit int, centre int, " + ", ".join(f"{c} double" for c in names))
    return parts.groupBy("fit", "centre").agg(*[F.sum(c).alias(c) for c in names]).collect()


def fit_all(points: DataFrame, ks, restarts: int, seed: int, max_iter: int = 20, tol: float = 1e-4) -> list[Fit]:
    """A fit for each k and each of ``restarts`` seeds over ``points`` (one
    column ``x``, array<double>).  A fit ends when no centre moves by more than
    ``tol`` or after ``max_iter`` steps; a centre without rows stays where it
    is; with fewer distinct points than k there are fewer centres.  No rows
    give no fits."""
    some = (points.groupBy("x").agg(F.count(F.lit(1)).alias("n")).orderBy(F.xxhash64("x"), "x")
            .limit(INIT_POINTS).collect())
    if not some:
        return []
    start, weight = np.array([r.x for r in some]), np.array([float(r.n) for r in some])
    d = start.shape[1]
    fits = [Fit(k, seed + i, first_centres(start, weight, k, seed + i)) for k in ks for i in range(restarts)]
    moving = list(fits)
    for turn in range(max_iter + 1):
        # the last turn only measures what the centres have become
        for f in moving:
            f.counts, f.squares, f.sums = np.zeros(len(f.centres)), np.zeros(len(f.centres)), np.zeros((len(f.centres), d))
            f.inertia.append(0.0)
        for r in _step(points, d, [f.centres for f in moving]):
            f = moving[r.fit]
            f.counts[r.centre], f.squares[r.centre] = r.n, r.squares
            f.sums[r.centre] = [r[f"s{i}"] for i in range(d)]
            f.inertia[-1] += r.cost
        still = []
        for f in moving if turn < max_iter else []:
            to = np.where(f.counts[:, None] > 0, f.sums / np.maximum(f.counts, 1)[:, None], f.centres)
            if np.sqrt(((to - f.centres) ** 2).sum(axis=1)).max() > tol:
                f.centres = to
                still.append(f)
        moving = still
        if not moving:
            break
    return fits


def best_by_k(fits: list[Fit]) -> dict[int, Fit]:
    """The fit of lowest inertia of each k, then of the lowest seed."""
    out: dict[int, Fit] = {}
    for f in sorted(fits, key=lambda f: (f.k, f.inertia[-1], f.seed)):
        out.setdefault(f.k, f)
    return out


def silhouettes(points: DataFrame, fits: list[Fit]) -> list[float]:
    """Mean squared-Euclidean silhouette of each fit, all in one scan: a row's
    mean squared distance to a cluster follows from the cluster's count, sum
    and squared norms.  A row alone in its cluster counts 0."""
    if not fits:
        return []
    d = fits[0].centres.shape[1]
    models = [(f.centres, f.counts, f.sums, f.squares) for f in fits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(models)), 0
        for x in _chunks(batches, d):
            rows += len(x)
            norm, at = (x * x).sum(axis=1), np.arange(len(x))
            for m, (centres, counts, sums, squares) in enumerate(models):
                own = squared_distances(x, centres).argmin(axis=1)
                apart = np.maximum(counts * norm[:, None] - 2 * x @ sums.T + squares, 0)
                mean = np.where(counts > 0, apart / np.maximum(counts, 1), np.inf)
                a = apart[at, own] / np.maximum(counts[own] - 1, 1)
                mean[at, own] = np.inf
                b = mean.min(axis=1)
                top = np.maximum(a, b)
                ok = (counts[own] > 1) & np.isfinite(b) & (top > 0)
                total[m] += ((b - a)[ok] / top[ok]).sum()
        yield pa.RecordBatch.from_pydict({"fit": np.arange(len(models), dtype=np.int32), "s": total,
                                          "n": np.full(len(models), rows, dtype=np.int64)})

    got = points.mapInArrow(run, "fit int, s double, n long").groupBy("fit").agg(
        (F.sum("s") / F.sum("n")).alias("s")).collect()
    return [r.s for r in sorted(got, key=lambda r: r.fit)]
