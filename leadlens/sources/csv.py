"""CSV source and sink for the supply-chain table layout.

Reading uses a declared schema (no inference pass), treats pandas' missing
tokens as NULL and normalises the header names (lower case, spaces to
underscores).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_name
from ..schema import CSV_HEADERS, FACT_COLUMNS, NA_TOKENS, csv_struct


def read_supply_chain_csv(spark: SparkSession, path: str, normalise: bool = True) -> DataFrame:
    """Scan CSV file(s) with the header row; typed as the reference's pandas
    reader infers them (int / double / string)."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [h for h in CSV_HEADERS if h not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    # columns in the file's own order, checked against each file's header, then taken by name
    raw = (spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
           .schema(T.StructType([T.StructField(h, T.StringType(), True) for h in header])).csv(path))
    typed = csv_struct()
    cols = []
    for f in typed.fields:
        c = F.col(f"`{f.name}`")
        c = F.when(c.isin(NA_TOKENS) | c.isNull(), None).otherwise(c)   # pandas' missing tokens
        if not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    df = raw.select(*cols)
    if normalise:
        names = [normalise_name(n) for n in df.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"column names collide after normalising: {names}")
        df = df.toDF(*names)
    return df


def write_supply_chain_csv(df: DataFrame, path: str) -> None:
    """Write the 24 base columns with the reference's header names."""
    out = df.select(*[F.col(n).alias(h) for (n, _), h in zip(FACT_COLUMNS, CSV_HEADERS)])
    out.write.mode("overwrite").option("header", True).csv(path)
