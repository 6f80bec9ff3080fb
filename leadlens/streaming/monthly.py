"""Incremental monthly snapshot with Structured Streaming.

New fact files landing in a folder update the per-month, per-product-type
aggregates; each micro-batch writes the (small) result table of its epoch.
Readers take the last epoch that is complete, so they never see a table in
the making, and a crash leaves the one before.  Sums and counts are kept in the state store, so the means stay exact; the state
holds one row per (month, product type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def monthly_snapshot_stream(spark: SparkSession, source_dir: str, output_dir: str, checkpoint_dir: str,
                            files_per_batch: int | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``source_dir`` holds fact parquet files (schema taken from them).  The
    output folder holds the full snapshot of every epoch."""
    schema = spark.read.parquet(source_dir).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    src = reader.parquet(source_dir)
    agg = (src.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"), "product_type")
           .agg(F.count(F.lit(1)).alias("total_orders"),
                F.sum("lead_time").alias("sum_lead_time"), F.count("lead_time").alias("n_lead_time"),
                F.sum("defect_rates").alias("sum_defect_rates"), F.count("defect_rates").alias("n_defect_rates")))

    def publish(batch: DataFrame, epoch: int) -> None:
        # complete mode: the batch is the whole snapshot; _SUCCESS, written last, publishes it
        batch.write.mode("overwrite").parquet(f"{output_dir}/epoch={epoch}")

    return (agg.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def last_epoch(spark: SparkSession, output_dir: str) -> int:
    """The last epoch whose table is complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{output_dir}/epoch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    epochs = [int(f.getPath().getParent().getName().split("=")[1]) for f in found]
    if not epochs:
        raise FileNotFoundError(f"no complete epoch in {output_dir}")
    return max(epochs)


def snapshot_table(spark: SparkSession, output_dir: str) -> DataFrame:
    """The published snapshot as the batch report's columns."""
    s = spark.read.parquet(f"{output_dir}/epoch={last_epoch(spark, output_dir)}")
    return (s.select("month", "product_type", "total_orders",
                     F.try_divide(F.col("sum_lead_time").cast("double"), F.col("n_lead_time").cast("double"))
                     .alias("avg_lead_time"),
                     F.try_divide(F.col("sum_defect_rates").cast("double"), F.col("n_defect_rates").cast("double"))
                     .alias("avg_defect_rate"))
            .orderBy(F.desc("month"), F.desc("avg_lead_time")))


def run_monthly_snapshot(spark: SparkSession, source_dir: str, work_dir: str,
                         files_per_batch: int | None = 1) -> DataFrame:
    """Run the stream over every file present, then return the snapshot."""
    q = monthly_snapshot_stream(spark, source_dir, f"{work_dir}/out", f"{work_dir}/state", files_per_batch)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return snapshot_table(spark, f"{work_dir}/out")
