"""The typed base table and its derived views in the Spark catalog.

``save_supply_chain`` is the DDL stage (namespace, drop-and-recreate,
fixed-point columns, surrogate id); ``register_views`` names the derived
relations as temporary views for SQL users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import SORT_PARTS, numbered
from ..operators import features as FE
from ..schema import FACT_COLUMNS, sql_type
from .fact import PART_ROWS, parts_of


def typed(df: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Coerce the base columns to the declared SQL types (decimals round
    half-up) and add a surrogate ``id``: 1..n in the order of all columns, so
    the same rows get the same ids however they are partitioned."""
    rows = df.select(*[F.col(n).cast(sql_type(t)).alias(n) for n, t in FACT_COLUMNS])
    n = df.count()
    return numbered(rows, [n for n, _ in FACT_COLUMNS], parts=parts_of(n, part_rows, SORT_PARTS), n_rows=n)


def save_supply_chain(spark: SparkSession, df: DataFrame, database: str = "supplychaindb",
                      table: str = "supply_chain", path: str | None = None,
                      partition_by: str | None = None) -> str:
    """CREATE DATABASE IF NOT EXISTS; DROP TABLE IF EXISTS; write the typed
    table.  Returns the qualified table name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    w = typed(df).write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


VIEW_NAMES = ["supply_chain", "supply_chain_dated", "product_type_encoding", "location_encoding", "sku_encoding",
              "supply_chain_encoded", "clustering_features", "ml_ready_data"]


def register_views(fact: DataFrame) -> list[str]:
    """Temp views: the base table, the three encodings, the encoded table,
    the z-score view and the ML export relation."""
    base = fact.select(*[n for n, _ in FACT_COLUMNS])
    base.createOrReplaceTempView("supply_chain")
    if "order_date" in fact.columns:
        fact.select(*[n for n, _ in FACT_COLUMNS], "order_date").createOrReplaceTempView("supply_chain_dated")
    for key in ("product_type", "location", "sku"):
        FE.encoding_view(base, key).createOrReplaceTempView(f"{key}_encoding")
    FE.encoded_fact(base).createOrReplaceTempView("supply_chain_encoded")
    FE.zscore_features(base).createOrReplaceTempView("clustering_features")
    FE.ml_ready(base).createOrReplaceTempView("ml_ready_data")
    return VIEW_NAMES
