"""Exact stratified train/test split, reproducible in any engine.

Rows of each stratum are ordered by ``md5('<seed>|<key>')``; the first
``n_test(stratum)`` rows form the test set.  Stratum sizes follow the
largest-remainder rule on the train share (the training allocation is
fixed first, the test set takes the rest), remainder ties by stratum name.

The cuts of all strata are found together by merged rank summaries, so no
stratum is sorted in one task, and joined to the rows by stratum; only the
stratum sizes and the cut values reach the driver.  A null stratum is a stratum
of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import values_at_ranks


def order_hash(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _hash_num(h: Column) -> Column:
    # first 13 hex digits = 52 bits: exact in a double, same order as the text
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double")


def allocate_test(sizes: dict[str, int], test_size: float = 0.2) -> dict[str, int]:
    """Test rows per stratum: train share by largest remainder, test = rest."""
    n = sum(sizes.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    cont = {k: v * n_train / n for k, v in sizes.items()}
    train = {k: math.floor(c) for k, c in cont.items()}
    left = n_train - sum(train.values())
    for k in sorted(sizes, key=lambda k: (-(cont[k] - train[k]), k is not None, k or ""))[:left]:
        train[k] += 1
    return {k: sizes[k] - train[k] for k in sizes}


def stratified_split(df: DataFrame, strata: str = "product_type", key: str = "sku",
                     test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` plus ``split`` = 'train' / 'test'."""
    name = F.col(strata).cast("string")
    hashed = df.withColumn("__h", order_hash(key, seed)).withColumn("__x", _hash_num(F.col("__h"))).withColumn("__s", name)
    sizes = {r[0]: r[1] for r in hashed.groupBy("__s").count().collect()}
    alloc = allocate_test(sizes, test_size)
    cut = values_at_ranks(hashed, "__s", "__x", {k: [n - 1] for k, n in alloc.items() if n > 0})
    # per stratum the cut value and how many test rows sit exactly on it
    cuts = df.sparkSession.createDataFrame(
        [(k, *cut[(k, n - 1)], n) for k, n in alloc.items() if n > 0],
        "__k string, __cut double, __first long, __n long")
    rows = hashed.join(cuts, F.col("__s").eqNullSafe(F.col("__k")), "left")
    # rows on a cut value (52-bit hash collisions: a handful at most) are
    # ranked by the full hash, then key
    w = Window.partitionBy("__s").orderBy("__h", key)
    ties = (rows.where(F.col("__x") == F.col("__cut"))
            .select("__s", key, "__n", "__first", F.row_number().over(w).alias("__rn")).collect())
    late = {r[key] for r in ties if r["__rn"] > r["__n"] - r["__first"]}
    on_cut = (F.col("__x") == F.col("__cut")) & ~F.col(key).isin(list(late)) if late else F.col("__x") == F.col("__cut")
    in_test = F.coalesce((F.col("__x") < F.col("__cut")) | on_cut, F.lit(False))
    return rows.select(*df.columns, F.when(in_test, "test").otherwise("train").alias("split"))
