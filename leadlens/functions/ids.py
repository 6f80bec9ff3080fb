"""Dense, stable row numbers without a single-task sort."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialise_parts

SORT_PARTS = 8               # ranges that many rows are sorted in
BOUND_ROWS = 4_096           # rows that the bounds of parts are taken from, about


def ranges(df: DataFrame, order: list[str], parts: int, rows: int):
    """``df`` (of about ``rows`` rows), cut into up to ``parts`` ranges of the order,
    one after the other.  The bounds are those of some rows, so the ranges are of
    about equal size; which rows changes nothing else.  The rows are written by
    range, without a shuffle, and a range is deleted when the next one is taken."""
    if parts <= 1:
        yield df
        return
    spark, kinds = df.sparkSession, dict(df.dtypes)
    some = df.select(*order).where(F.rand(1) < BOUND_ROWS / max(1, rows)).orderBy(*order).collect()
    bounds = list(dict.fromkeys(some[len(some) * k // parts] for k in range(1, parts) if some))
    at = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order)])      # nulls come first in structs too
    cuts = [F.struct(*[F.lit(v).cast(kinds[c]).alias(f"c{i}") for i, (c, v) in enumerate(zip(order, b, strict=True))])
            for b in bounds]
    of = "__range"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/ranges-{uuid.uuid4().hex}"
    df.withColumn(of, sum([(at >= c).cast("int") for c in cuts], F.lit(0))).write.partitionBy(of).parquet(path)
    folder = lambda k: spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{of}={k}" if k is not None else path)
    fs = folder(None).getFileSystem(spark._jsc.hadoopConfiguration())
    for k in range(len(bounds) + 1):
        if fs.exists(folder(k)):
            yield spark.read.schema(df.schema).parquet(folder(k).toString())
            fs.delete(folder(k), True)
    fs.delete(folder(None), True)


def numbered(df: DataFrame, order: list[str], name: str = "id", start: int = 1, parts: int = 1, n_rows: int = 0) -> DataFrame:
    """``df`` with ``name`` = start, start + 1, ... in the order of the columns
    ``order`` (ascending, nulls first).

    The rows are range-partitioned and sorted by the order, numbered within
    their partition and written, ``parts`` ranges (of about ``n_rows`` rows in all)
    one after the other; each partition's offset is the count of the
    partitions before it, a table of one row per partition.  The numbers
    depend on the order alone, not on the number of partitions; rows that tie
    on all of ``order`` share a run of numbers in any order.
    """
    mark, part, at = f"__{name}_mark", f"__{name}_part", f"__{name}_range"
    rows = materialise_parts(df.sparkSession, (
        r.orderBy(*order).withColumn(mark, F.monotonically_increasing_id()).withColumn(at, F.lit(k))
        for k, r in enumerate(ranges(df, order, parts, n_rows))), "numbered")
    rows = rows.withColumn(part, F.shiftright(mark, 33))
    sizes = rows.groupBy(at, part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(at, part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select(at, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    in_part = F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    # so few rows that the hint holds at any size; without it all rows are shuffled for them
    return rows.join(F.broadcast(offsets), [at, part]).select(
        (F.col("__offset") + in_part + start).alias(name), *[F.col(f"`{c}`") for c in df.columns])
