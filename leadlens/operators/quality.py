"""Data-quality profile and cleaning (the Python script's cleaning stage).

Every profile is a single aggregate pass; decisions that depend on it
(which columns to drop, which values to impute) collect one small row and
then stay lazy.  Order of the stages follows the reference: profile ->
drop sparse columns -> impute -> dedupe -> rename -> standardise text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles
from ..functions.text import normalise_name, strip_title

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns per data type (schema metadata; no data is read)."""
    counts: dict[str, int] = {}
    for _, t in df.dtypes:
        counts[t] = counts.get(t, 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items(), key=lambda kv: (-kv[1], kv[0])),
                                           "dtype string, columns int")


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct) for every column, in one pass,
    sorted by missing percentage (descending, then column name)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
                                for i, c in enumerate(cols)]))
    return (row.select(F.col("__n"), stack.alias("s"))
            .select("s.column", F.col("s.missing_count").cast("bigint").alias("missing_count"),
                    F.round(F.try_divide(F.col("s.missing_count").cast("double") * F.lit(100.0),
                                         F.col("__n").cast("double")), 6)
                    .alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column"))


def sparse_columns(df: DataFrame, max_missing_pct: float = 50.0) -> list[str]:
    """Columns with strictly more than ``max_missing_pct`` % missing."""
    return [r.column for r in missing_profile(df).where(F.col("missing_pct") > max_missing_pct).collect()]


def drop_sparse_columns(df: DataFrame, max_missing_pct: float = 50.0) -> DataFrame:
    return df.drop(*sparse_columns(df, max_missing_pct))


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, smallest value among ties (nulls
    ignored).  Value counts are pre-aggregated per (column, value), so a
    hot value is one row; the arg-max is a plain aggregate."""
    if not cols:
        return {}
    parts = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("v")) for c in cols]
    counts = (df.select(F.explode(F.array(*parts)).alias("kv")).select("kv.*").where(F.col("v").isNotNull())
              .groupBy("key", "v").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("b"))
    got = {r.key: r.b.v for r in best.collect()}
    return {c: got.get(c) for c in cols}


def impute(df: DataFrame, gaps: set[str] | None = None) -> DataFrame:
    """Median for numeric columns with gaps (such columns become double, as
    an integer column with gaps does in pandas), mode for the others.
    ``gaps`` (columns with missing values) is profiled when not given."""
    if gaps is None:
        gaps = {r.column for r in missing_profile(df).where(F.col("missing_count") > 0).collect()}
    num = [c for c in numeric_columns(df) if c in gaps]
    oth = [c for c in df.columns if c in gaps and c not in num]
    med = exact_quantiles(df, num, [0.5]) if num else {}
    mod = modes(df, oth)
    out = []
    for c in df.columns:
        if c in num:
            fill = med[c][0]
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(fill).cast("double")).alias(c))
        elif c in oth and mod.get(c) is not None:
            out.append(F.coalesce(F.col(c), F.lit(mod[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows (nulls equal)."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")))


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def normalise_names(df: DataFrame) -> DataFrame:
    names = [normalise_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalising: {names}")
    return df.toDF(*names)


def standardise_text(df: DataFrame, cols=("inspection_results", "transportation_modes")) -> DataFrame:
    """strip + title case for the named category columns, when present."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: strip_title(c) for c in present}) if present else df


def category_audit(df: DataFrame, k: int = 5) -> DataFrame:
    """Top-k value counts of every string column (count desc, value asc).

    One distributed top-k per column (partial top-k per partition, then a
    merge of k x partitions rows), unioned; no column's values are
    gathered in one task.
    """
    parts = []
    for c in string_columns(df):
        parts.append(df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
                     .agg(F.count(F.lit(1)).alias("count"))
                     .orderBy(F.desc("count"), F.asc("value")).limit(k)
                     .select(F.lit(c).alias("column"), "value", "count"))
    return reduce(DataFrame.unionByName, parts)


def clean(df: DataFrame, max_missing_pct: float = 50.0) -> DataFrame:
    """The whole cleaning stage (one profiling pass serves the drop and the
    imputation)."""
    prof = missing_profile(df).collect()
    sparse = [r.column for r in prof if r.missing_pct > max_missing_pct]
    out = df.drop(*sparse)
    out = impute(out, {r.column for r in prof if r.missing_count > 0 and r.column not in sparse})
    out = dedupe(out)
    out = normalise_names(out)
    return standardise_text(out)


def with_gaps(fact: DataFrame) -> DataFrame:
    """Deterministic gaps and untidy text on the fact relation, for the
    cleaning stage to act on: nulls derived from the row's own values, one
    column more than half empty, padded lower-case category text."""
    return fact.select(
        "product_type", "sku",
        F.when(F.col("availability") <= 45, F.col("price")).alias("price"),
        "availability", "number_of_products_sold", "revenue_generated",
        F.when(F.col("stock_levels") != 0, F.col("customer_demographics")).alias("customer_demographics"),
        "stock_levels", "lead_times", "order_quantities", "shipping_times", "shipping_carriers",
        "shipping_costs", "supplier_name", "location", "lead_time",
        F.when(F.col("production_volumes") <= 400, F.col("production_volumes")).alias("production_volumes"),
        "manufacturing_lead_time", "manufacturing_costs",
        F.concat(F.lit(" "), F.lower("inspection_results"), F.lit("\t")).alias("inspection_results"),
        F.when(F.col("manufacturing_lead_time") != 0, F.col("defect_rates")).alias("defect_rates"),
        F.concat(F.lower("transportation_modes"), F.lit("  ")).alias("transportation_modes"),
        F.when(F.col("lead_time") <= 18, F.col("routes")).alias("routes"),
        "costs",
    )
