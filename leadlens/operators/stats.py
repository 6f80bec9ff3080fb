"""Descriptive statistics of the fact relation (the Python script's EDA stage).

All outputs are small DataFrames derived from one or two aggregate passes;
exact quantiles come from ``functions.quantiles`` (merged rank summaries),
correlations from one pass that folds the moments of all column pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import mean
from ..functions.moments import correlations
from ..functions.quantiles import Stat, exact_quantiles, interpolated, profile, quantile_ranks
from .quality import numeric_columns, string_columns

D = 6  # digits kept in reported doubles


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact, interpolated), max
    per numeric column: one row per column; NaN counts as missing.

    One scan gives the moments, the extremes and proven intervals around the
    quartiles; another settles the quartiles of columns with many values."""
    cols = cols or numeric_columns(df)
    quartiles = [0.25, 0.5, 0.75]
    stats, picked = profile(df, [F.col(c) for c in cols], quantile_ranks(quartiles))
    r6 = lambda v: None if v is None else round(v, D)
    rows = []
    for i, c in enumerate(cols):
        s = stats.get((None, i), Stat())
        std = round(round((s.m2 / (s.n - 1)) ** 0.5, 8), D) if s.n > 1 else None
        q = interpolated(stats, picked, (None, i), quartiles)
        rows.append((c, s.n, r6(s.mean if s.n else None), std, s.low, *map(r6, q), s.high))
    return df.sparkSession.createDataFrame(
        rows, "column string, count bigint, mean double, std double, min double, q25 double, q50 double, "
              "q75 double, max double")


def mean_median(df: DataFrame, col: str = "lead_time") -> DataFrame:
    med = exact_quantiles(df, [col], [0.5])[col][0]
    return df.agg(mean(col).alias("mean"), F.lit(med).cast("double").alias("median"))


def histogram(df: DataFrame, col: str = "lead_time", bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins kept.

    (min, max) come from one aggregate; the bin counts (at most ``bins``
    rows) are joined to the grid of bins."""
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = F.lit(rng.lo).cast("double"), F.lit(rng.hi).cast("double")
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(F.lit(bins), F.floor((x - lo) / width).cast("int") + 1))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if rng.lo is None:
        grid = grid.limit(0)
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select(F.col("bin").cast("bigint").alias("bin"), F.round(lo + (F.col("bin") - 1) * width, D).alias("bin_start"),
                    F.round(lo + F.col("bin") * width, D).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .orderBy("bin"))


def box_summary(df: DataFrame, col: str = "lead_time", whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest points within whis x IQR) and flier count."""
    q1, q2, q3 = exact_quantiles(df, [col], [0.25, 0.5, 0.75])[col]
    x = F.col(col).cast("double")
    if q1 is None:
        lo_f = hi_f = None
    else:
        iqr = q3 - q1
        lo_f, hi_f = q1 - whis * iqr, q3 + whis * iqr
    inside = x.between(F.lit(lo_f), F.lit(hi_f))
    return df.agg(
        F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(x.isNotNull() & ~inside).cast("bigint").alias("fliers"))


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (x, y, corr) for every
    ordered pair incl. the diagonal, from one pass over the rows.  ``i``/``j``
    are column positions (lower triangle: i > j)."""
    return correlations(df, cols or numeric_columns(df))


def target_correlations_all(df: DataFrame, target: str = "lead_time",
                            cols: list[str] | None = None) -> DataFrame:
    """(feature, corr) of every numeric column (target included) with the target."""
    cols = cols or numeric_columns(df)
    matrix = correlations(df, list(dict.fromkeys([*cols, target])))
    return matrix.where((F.col("y") == target) & F.col("x").isin(cols)).select(F.col("x").alias("feature"), "corr")


def target_correlations(df: DataFrame, target: str = "lead_time", k: int = 10, bottom: bool = False) -> DataFrame:
    """Correlations with the target, sorted descending (self included);
    the first k, or the last k (still in descending order)."""
    m = target_correlations_all(df, target)
    if bottom:
        return m.orderBy(F.asc_nulls_first("corr"), F.desc("feature")).limit(k).orderBy(F.desc("corr"), "feature")
    return m.orderBy(F.desc_nulls_last("corr"), "feature").limit(k)


def correlation_lower_triangle(df: DataFrame) -> DataFrame:
    return correlation_matrix(df).where(F.col("i") > F.col("j")).orderBy("i", "j")


def value_counts_top(df: DataFrame, k: int = 10, n_cols: int = 3) -> DataFrame:
    """Value counts (desc) of the first ``n_cols`` string columns, top k each."""
    parts = [df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
             .orderBy(F.desc("count"), "value").limit(k).select(F.lit(c).alias("column"), "value", "count")
             for c in string_columns(df)[:n_cols]]
    return reduce(DataFrame.unionByName, parts)


def category_mean_top(df: DataFrame, target: str = "lead_time", k: int = 10, n_cols: int = 3) -> DataFrame:
    """Mean target per category of the first ``n_cols`` string columns,
    highest k each."""
    parts = [df.groupBy(F.col(c).alias("value")).agg(mean(target).alias("avg_lead_time"))
             .orderBy(F.desc("avg_lead_time"), "value").limit(k)
             .select(F.lit(c).alias("column"), "value", "avg_lead_time")
             for c in string_columns(df)[:n_cols]]
    return reduce(DataFrame.unionByName, parts)


def frequency(df: DataFrame, col: str, by_key: bool = False) -> DataFrame:
    """value_counts(): count per value, descending (or in key order)."""
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(col) if by_key else out.orderBy(F.desc("count"), col)
