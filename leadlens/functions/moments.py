"""All pairwise moments of many columns in one pass.

Each task folds its rows into a matrix of counts, means, centred sums of
products and extremes for every pair of columns, over the rows where both are
present, and hands on one row per pair.  The rows merge exactly (Chan, Golub &
LeVeque 1979), so the input is scanned once, whatever the number of columns
and wherever the gaps are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

SCHEMA = "i int, j int, n long, mi double, mj double, cij double, cii double, cjj double, lo double, hi double"


def _fold(x: np.ndarray, there: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of one batch; entry [i, j] is of column i (and j) over the rows
    that have both."""
    w = there.astype(np.float64)
    count = w.sum(axis=0)
    centre = np.where(there, x, 0).sum(axis=0) / np.maximum(count, 1)
    y = np.where(there, x - centre, 0)
    n, s, ss, p = w.T @ w, y.T @ w, (y * y).T @ w, y.T @ y
    m = np.maximum(n, 1)
    lo, hi = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
    for j in range(x.shape[1]):
        rows = there[:, j]
        lo[:, j] = np.where(there[rows], x[rows], np.inf).min(axis=0, initial=np.inf)
        hi[:, j] = np.where(there[rows], x[rows], -np.inf).max(axis=0, initial=-np.inf)
    return {"n": n, "mi": s / m + centre[:, None], "cij": p - s * s.T / m, "cii": ss - s * s / m, "lo": lo, "hi": hi}


def _merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    n = a["n"] + b["n"]
    m = np.maximum(n, 1)
    gap, share = b["mi"] - a["mi"], a["n"] * b["n"] / m
    return {"n": n, "mi": (a["n"] * a["mi"] + b["n"] * b["mi"]) / m, "cij": a["cij"] + b["cij"] + gap * gap.T * share,
            "cii": a["cii"] + b["cii"] + gap * gap * share, "lo": np.minimum(a["lo"], b["lo"]), "hi": np.maximum(a["hi"], b["hi"])}


def moment_parts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per task and ordered pair of columns (i, j), see SCHEMA; mj and
    cjj are of column j, lo and hi of column i."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            one = _fold(x, there)
            total = one if total is None else _merge(total, one)
        if total is not None:
            i, j = np.nonzero(total["n"] > 0)
            got = {c: total[c][i, j] for c in ("mi", "cij", "cii", "lo", "hi")} | {
                "i": i.astype(np.int32), "j": j.astype(np.int32), "n": total["n"][i, j].astype(np.int64),
                "mj": total["mi"][j, i], "cjj": total["cii"][j, i]}
            yield pa.RecordBatch.from_pydict({c: got[c] for c in [f.split()[0] for f in SCHEMA.split(", ")]})

    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(run, SCHEMA)


def merged_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per ordered pair of columns (i, j) with common rows: n, mean_i,
    cij, cii and cjj over these rows, and whether column i varies there."""
    parts = materialise(moment_parts(df, cols), "moments")
    mean = parts.groupBy("i", "j").agg((F.sum(F.col("n") * F.col("mi")) / F.sum("n")).alias("mean_i"),
                                       (F.sum(F.col("n") * F.col("mj")) / F.sum("n")).alias("mean_j"))
    a, b = F.col("mi") - F.col("mean_i"), F.col("mj") - F.col("mean_j")
    return parts.join(mean, ["i", "j"]).groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.min("mean_i").alias("mean_i"), F.sum(F.col("cij") + F.col("n") * a * b).alias("cij"),
        F.sum(F.col("cii") + F.col("n") * a * a).alias("cii"), F.sum(F.col("cjj") + F.col("n") * b * b).alias("cjj"),
        (F.min("lo") < F.max("hi")).alias("varies"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x, y, i, j, corr) of every ordered pair: Pearson r over the rows that
    have both, to 6 digits; NULL when a side is constant or no row has both."""
    whole = merged_moments(df, cols)
    other = whole.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("varies").alias("other_varies"))
    r = F.when(F.col("varies") & F.col("other_varies"), F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(
        F.round(F.col("cij") / (F.sqrt("cii") * F.sqrt("cjj")), 6)))
    pairs = df.sparkSession.createDataFrame([(x, y, i, j) for i, x in enumerate(cols) for j, y in enumerate(cols)],
                                            "x string, y string, i int, j int")
    return pairs.join(whole.join(other, ["i", "j"]).select("i", "j", r.alias("corr")), ["i", "j"], "left").select(
        "x", "y", "i", "j", "corr")
