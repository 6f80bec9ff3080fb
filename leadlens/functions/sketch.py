"""Mergeable summary of the ranks of a multiset of doubles, with proven bounds.

A summary keeps some of the distinct values in ascending order and, for each
kept value v, lower and upper bounds of the number of rows < v and of the
number of rows <= v.  Bounds of two summaries add up at any value, so summaries
merge in any order without a loss of their own; only pruning to fewer values
widens the bounds, and what it costs is in the bounds.  A value that many rows
hold stays exact: its two counts lie far apart.  While nothing was pruned all
bounds are equal and every rank is known exactly.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LT_LO, LT_HI, LE_LO, LE_HI = range(4)


class Summary(NamedTuple):
    n: int
    values: np.ndarray      # ascending, distinct; holds the minimum and the maximum
    bounds: np.ndarray      # rows LT_LO, LT_HI, LE_LO, LE_HI

    def at(self, x: np.ndarray) -> np.ndarray:
        """The four bounds at any values."""
        m = len(self.values)
        i = np.searchsorted(self.values, x, "left")
        here = np.minimum(i, m - 1)
        below = np.where(i > 0, self.bounds[LE_LO][np.maximum(i, 1) - 1], 0)
        above = np.where(i < m, self.bounds[LT_HI][here], self.n)
        between = np.stack([below, above, below, above])
        return np.where(self.values[here] == x, self.bounds[:, here], between)

    def merge(self, other: Summary) -> Summary:
        values = np.union1d(self.values, other.values)
        return Summary(self.n + other.n, values, self.at(values) + other.at(values))

    def prune(self, size: int) -> Summary:
        """At most ``size`` + 2 values, evenly spaced in rank, once there are
        more than twice as many."""
        m = len(self.values)
        if m <= 2 * size:
            return self
        ranks = np.linspace(0, self.n - 1, size)
        at = np.searchsorted(self.bounds[LE_LO], ranks, "right")
        keep = np.unique(np.concatenate([[0], np.minimum(at, m - 1), [m - 1]]))
        return Summary(self.n, self.values[keep], self.bounds[:, keep])

    def bracket(self, rank: int) -> tuple[float, float, int | None]:
        """Values lo <= hi that hold the value of a 0-based rank between them,
        and the number of rows below it where the summary knows it."""
        hi = int(np.searchsorted(self.bounds[LE_LO], rank, "right"))
        lo = int(np.searchsorted(self.bounds[LT_HI], rank, "right")) - 1
        known = lo == hi and self.bounds[LT_LO][lo] == self.bounds[LT_HI][lo]
        return float(self.values[lo]), float(self.values[hi]), int(self.bounds[LT_LO][lo]) if known else None

    def pack(self) -> bytes:
        return np.int64(self.n).tobytes() + self.values.tobytes() + self.bounds.tobytes()


def unpack(data: bytes) -> Summary:
    n, m = int(np.frombuffer(data, np.int64, 1)[0]), (len(data) - 8) // 40
    return Summary(n, np.frombuffer(data, np.float64, m, 8), np.frombuffer(data, np.int64, 4 * m, 8 + 8 * m).reshape(4, m))


def summarise(x: np.ndarray) -> Summary:
    """The exact summary of some rows (at least one, no NaN)."""
    values, count = np.unique(x, return_counts=True)
    le = np.cumsum(count, dtype=np.int64)
    return Summary(len(x), values, np.stack([le - count, le - count, le, le]))


def merge_all(parts: list[Summary], size: int) -> Summary:
    """All summaries as one, in rounds of pairs, so a row's bounds pass through
    a logarithmic number of prunings."""
    while len(parts) > 1:
        parts = [parts[i].merge(parts[i + 1]).prune(size) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


class Fold:
    """Rows of one column seen by one task: their summary, mean and centred sum
    of squares (Chan, Golub & LeVeque 1979).

    Rows wait in a buffer; full buffers become summaries, and two summaries of
    one level become one of the next, so memory grows with the logarithm of
    the rows."""

    def __init__(self, size: int):
        self.size, self.wait, self.waiting = size, [], 0
        self.levels: list[tuple[int, Summary]] = []
        self.n, self.mean, self.m2, self.below = 0, 0.0, 0.0, 0

    def add(self, x: np.ndarray) -> None:
        if not len(x):
            return
        mean = float(x.mean())
        self.n, self.mean, self.m2 = merge_moments((self.n, self.mean, self.m2), (len(x), mean, float(((x - mean) ** 2).sum())))
        self.wait.append(x)
        self.waiting += len(x)
        if self.waiting >= 16 * self.size:
            self.flush()

    def flush(self) -> None:
        if self.wait:
            one, level = summarise(np.concatenate(self.wait)).prune(self.size), 0
            self.wait, self.waiting = [], 0
            while self.levels and self.levels[-1][0] == level:
                one, level = self.levels.pop()[1].merge(one).prune(self.size), level + 1
            self.levels.append((level, one))

    def summary(self) -> Summary | None:
        self.flush()
        return merge_all([s for _, s in reversed(self.levels)], self.size) if self.levels else None


def merge_moments(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return (n, a[1], a[2]) if a[0] else (n, b[1], b[2])
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap * gap * (a[0] * b[0] / n)
