"""Exact order statistics, quantiles (linear interpolation, as pandas / SQL
``quantile_cont``) and moments of many columns or groups in a few scans.

Spark's exact ``percentile`` merges a map of every distinct value of a group in
one task, which does not hold for high-cardinality doubles.  Here one scan
folds the rows of every column into mergeable rank summaries of bounded size
(``functions.sketch``), whose bounds prove an interval [lo, hi] around each
rank, whatever the data.  A column with few distinct values is settled by that
scan.  The next scan counts the rows below each open interval and summarises
the rows inside it, which is exact once the interval holds few distinct values.
Random doubles take two scans at ten million rows and three at 40 million;
each further scan narrows the intervals by some three orders of magnitude.

A task hands on one summary per column (or group) and interval; summaries
merge in two rounds, by blocks of tasks and then all.  Only the intervals and
the selected values reach the driver.  A value holding a third of the rows is
one entry of a summary; no group's rows are gathered or sorted anywhere.

NULL and NaN are missing values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sketch import Fold, Summary, merge_all, merge_moments, unpack

SIZE = 2048        # values a summary of the first scan keeps (up to twice as many)
MORE = 8           # times as many in each further scan,
MOST = 65_536      # up to this many
BLOCKS = 512       # blocks of tasks whose summaries are merged first
PART = "grp string, col int, slot int, part int, below long, n long, mean double, m2 double, summary binary"
FOUND = ("grp string, col int, slot int, n long, mean double, m2 double, low double, high double, "
         "found array<struct<rank:long,lo:double,hi:double,before:long>>")

Name = tuple[str | None, int]      # (group, column)


class Stat(NamedTuple):
    n: int = 0
    mean: float | None = None
    m2: float | None = None
    low: float | None = None
    high: float | None = None


def _fold(df: DataFrame, size: int, slots: dict[Name, list[tuple[int, float, float]]] | None) -> DataFrame:
    """One row per task, (group, column) and interval (see PART) from one scan
    of ``df`` (the group, then a double per column).  Without ``slots`` a
    column is one interval, slot 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple, Fold] = {}

        def take(name: Name, x: np.ndarray) -> None:
            for slot, lo, hi in ([(0, None, None)] if slots is None else slots.get(name, [])):
                fold = state.get((*name, slot))
                if fold is None:
                    fold = state[(*name, slot)] = Fold(size)
                if lo is None:
                    fold.add(x)
                else:
                    fold.below += int(np.count_nonzero(x < lo))
                    fold.add(x[(x >= lo) & (x <= hi)])

        for batch in batches:
            groups = batch.column(0)
            if groups.null_count == len(groups):
                parts = [(None, slice(None))]
            else:
                coded = groups.dictionary_encode()
                codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                order = np.argsort(codes, kind="stable")
                cuts = np.flatnonzero(np.diff(codes[order])) + 1
                names = coded.dictionary.to_pylist()
                parts = [(names[codes[rows[0]]] if codes[rows[0]] >= 0 else None, rows)
                         for rows in np.split(order, cuts) if len(rows)]
            for c in range(1, batch.num_columns):
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                for name, rows in parts:
                    take((name, c - 1), (y := x[rows])[~np.isnan(y)])
        part, rows = TaskContext.get().partitionId(), []
        for (name, c, slot), fold in state.items():
            s = fold.summary()
            rows.append((name, c, slot, part, fold.below, fold.n, fold.mean, fold.m2, s and s.pack()))
        if rows:
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types, strict=True)],
                                             names=[x.split()[0] for x in PART.split(", ")])
    return df.mapInArrow(run, PART)


def _merged(pdf: pd.DataFrame, size: int) -> tuple[int, tuple[int, float, float], Summary | None]:
    pdf = pdf.sort_values("part")
    moments = (0, 0.0, 0.0)
    for one in zip(pdf["n"].tolist(), pdf["mean"].tolist(), pdf["m2"].tolist()):
        moments = merge_moments(moments, one)
    parts = [unpack(x) for x in pdf["summary"] if x is not None]
    return int(pdf["below"].sum()), moments, merge_all(parts, size) if parts else None


def _brackets(parts: DataFrame, size: int, ranks: Callable[[Name, int, int], list[int]]) -> list:
    """Merge the parts and bracket the ranks asked for: ``ranks(name, slot, n)``
    are 0-based in the whole column; rows below the interval come off."""
    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        below, (n, mean, m2), s = _merged(pdf, size)
        first = pdf.iloc[0]
        return pd.DataFrame({"grp": [first["grp"]], "col": [first["col"]], "slot": [first["slot"]], "part": [pdf["part"].min()],
                             "below": [below], "n": [n], "mean": [mean], "m2": [m2], "summary": [s and s.pack()]})

    def every(pdf: pd.DataFrame) -> pd.DataFrame:
        below, (n, mean, m2), s = _merged(pdf, size)
        first, found = pdf.iloc[0], []
        for r in ranks((first["grp"], int(first["col"])), int(first["slot"]), n) if s else []:
            lo, hi, before = s.bracket(r - below)
            found.append({"rank": r, "lo": lo, "hi": hi, "before": None if before is None else below + before})
        return pd.DataFrame({"grp": [first["grp"]], "col": [first["col"]], "slot": [first["slot"]], "n": [n], "mean": [mean], "m2": [m2],
                             "low": [float(s.values[0]) if s else None], "high": [float(s.values[-1]) if s else None],
                             "found": [found]})

    blocks = parts.groupBy("grp", "col", "slot", (F.col("part") % BLOCKS).alias("_b")).applyInPandas(some, PART)
    return blocks.groupBy("grp", "col", "slot").applyInPandas(every, FOUND).collect()


def profile(df: DataFrame, exprs: list[Column], ranks_of: Callable[[Name, int], list[int]], group: Column | None = None,
            size: int = SIZE) -> tuple[dict[Name, Stat], dict[tuple[Name, int], tuple[float, int]]]:
    """Statistics and selected order statistics per (group, column position).

    ``ranks_of(name, n)`` gives the 0-based ranks wanted of a column with n
    values (it runs in tasks).  Returns the moments and extremes per name, and
    per (name, rank) its value and the first rank that holds this value.
    Groups are as text; their number, times ``size``, has to fit in a task."""
    key = (F.lit(None) if group is None else group).cast("string")
    clean = [F.when(~F.isnan(e.cast("double")), e.cast("double")) for e in exprs]
    wanted = list(range(len(clean)))
    stats: dict[Name, Stat] = {}
    picked: dict[tuple[Name, int], tuple[float, int]] = {}
    slots: dict[Name, list[tuple[int, float, float]]] | None = None
    asked: dict[tuple[Name, int], list[int]] = {}
    while wanted:
        place = {c: i for i, c in enumerate(wanted)}
        rows = df.select(key.alias("grp"), *[clean[c].alias(f"c{c}") for c in wanted])
        near = None if slots is None else {(g, place[c]): v for (g, c), v in slots.items()}
        if slots is None:
            ranks = lambda name, _, n: sorted({r for r in ranks_of(name, n) if 0 <= r < n})
        else:
            local = {((g, place[c]), s): v for ((g, c), s), v in asked.items()}
            ranks = lambda name, slot, _, local=local: local[(name, slot)]
        open_: dict[Name, dict[tuple[float, float], list[int]]] = {}
        for row in _brackets(_fold(rows, size, near), size, ranks):
            name = (row.grp, wanted[row.col])
            if slots is None:
                stats[name] = Stat(row.n, row["mean"], row.m2, row.low, row.high)
            for f in row.found:
                if f.before is not None:
                    picked[(name, f.rank)] = (f.lo, f.before)
                else:
                    open_.setdefault(name, {}).setdefault((f.lo, f.hi), []).append(f.rank)
        slots = {name: [(i, lo, hi) for i, (lo, hi) in enumerate(at)] for name, at in open_.items()}
        asked = {(name, i): v for name, at in open_.items() for i, v in enumerate(at.values())}
        wanted = sorted({c for _, c in open_})
        size = min(size * MORE, max(size, MOST))
    return stats, picked


def _ranks_for(n: int, probs: list[float]) -> list[tuple[int, int, float]]:
    return [(math.floor(pos), math.ceil(pos), pos) for pos in ((n - 1) * p for p in probs)]


def select_ranks(df: DataFrame, exprs: dict[str, Column], ranks_of, size: int = SIZE):
    """For each named double expression, the value at the 0-based ranks
    ``ranks_of(name, n)`` of its ascending order.

    Returns ``(sizes, picked)``: row counts per name and
    ``{(name, rank): (value, first rank holding that value)}``."""
    names = list(exprs)
    stats, picked = profile(df, list(exprs.values()), lambda name, n: ranks_of(names[name[1]], n), size=size)
    return ({k: stats.get((None, i), Stat()).n for i, k in enumerate(names)},
            {(names[c], r): v for ((_, c), r), v in picked.items()})


def values_at_ranks(df: DataFrame, key_col: str, value_col: str, ranks: dict[str, list[int]],
                    size: int = SIZE) -> dict[tuple[str, int], tuple[float, int]]:
    """Per group of ``key_col`` (groups named in ``ranks``), the value of
    ``value_col`` at each 0-based rank, with the first rank holding it (so
    ties at the value can be told apart)."""
    _, picked = profile(df, [F.col(value_col)], lambda name, n: ranks.get(name[0], []), F.col(key_col), size)
    return {(k, r): v for ((k, _), r), v in picked.items()}


def interpolated(stats: dict[Name, Stat], picked: dict, name: Name, probs: list[float]) -> list[float | None]:
    """Quantiles of one column from the ranks of ``quantile_ranks``."""
    n = stats.get(name, Stat()).n
    if not n:
        return [None] * len(probs)
    out = []
    for a, b, pos in _ranks_for(n, probs):
        xa, xb = picked[(name, a)][0], picked[(name, b)][0]
        out.append(xa if a == b else xa + (xb - xa) * (pos - a))
    return out


def quantile_ranks(probs: list[float]) -> Callable[[Name, int], list[int]]:
    return lambda _, n: [r for a, b, _ in _ranks_for(n, probs) for r in (a, b)]


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], size: int = SIZE) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of each column.

    Returns ``{column: [q(p) for p in probs]}``; ``None`` for an empty column.
    """
    stats, picked = profile(df, [F.col(c) for c in cols], quantile_ranks(probs), size=size)
    return {c: interpolated(stats, picked, (None, i), probs) for i, c in enumerate(cols)}
