"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; we only read its
settings.  ``get_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Defaults for local runs.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splits hot partitions.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "leadlens", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    # "local-cluster" has executors of their own
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir`` (and make
    it the RDD checkpoint folder).

    Only a local session without one gets a fixed local folder; a cluster
    session must name a shared folder (a machine-local folder would not
    survive executor loss).
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = os.environ.get("LEADLENS_LOCAL_CHECKPOINT_DIR",
                              os.path.join(tempfile.gettempdir(), "leadlens-checkpoints"))
        os.makedirs(base, exist_ok=True)
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


#: Spark deletes a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries inside go when each has ended, not when the
    driver next collects its garbage; for writes, whose results are files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, tag: str, schema: StructType | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table,
    read with ``schema`` if given; with ``by`` a folder for each value of that
    column, see ``with_value``.

    Cuts the lineage: what reads the result reads files, so a lost executor
    costs a reread and not a recomputation."""
    return materialise_parts(df.sparkSession, [df], tag, schema, by)


def materialise_parts(spark: SparkSession, parts, tag: str, schema: StructType | None = None, by: str | None = None) -> DataFrame:
    """``materialise`` of the union of ``parts``, written one by one: the shuffle
    files of a part go before the next one begins."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{tag}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        for df in parts:
            df.write.mode("append").parquet(path, partitionBy=by)
            schema = schema or df.schema
    out = spark.read.schema(schema).parquet(path)
    out.written_at = path
    return out


def with_value(table: DataFrame, by: str, value: str) -> DataFrame:
    """The rows of a table written ``by`` a column that have its value, without
    the column: the value's folder, whose size Spark knows (of a filter it does not)."""
    spark, names = table.sparkSession, [c for c in table.columns if c != by]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.written_at}/{by}={value}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return table.where(F.col(by) == value).select(*names)         # no such rows, or a name that paths escape
    return spark.read.schema(table.select(*names).schema).parquet(path.toString())


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote.  Only for tables of the
    caller's own, once all that it made of them is written: what is read later
    must not go back to them, also after the loss of an executor."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
