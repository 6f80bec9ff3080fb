"""Feature engineering (the Python script's feature stage and the SQL
script's encoding views).

Row-wise features are column expressions inside one projection.  Target
encodings are computed for all category columns in one aggregate pass
(pre-aggregated per (column, value), so hot values cost one row) and
joined back without a broadcast hint.  Quantile edges come from exact
distributed selection.  One-hot features are in ``sparse.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import mean
from ..functions.quantiles import exact_quantiles
from ..session import discard, materialise, materialise_parts, with_value
from ..sources.fact import PART_ROWS, in_part, parts_of
from ..schema import (CLUSTER_FEATURES, DEFECT_BIN_EDGES, DEFECT_BIN_LABELS, INSPECTION_SCORES, LOG_FEATURES,
                      SQUARED_FEATURES, TARGET, TRANSPORT_CODES, VOLUME_QUARTILE_LABELS, ZSCORE_FEATURES)
from .joins import join_lookup
from .quality import string_columns


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def zero_to_one(c: str) -> Column:
    """pandas ``.replace(0, 1)`` on a divisor (NULL stays NULL)."""
    x = _d(c)
    return F.when(x == 0, F.lit(1.0)).otherwise(x)


# ---- row-wise features ----------------------------------------------------

def log_features(df: DataFrame, cols=LOG_FEATURES) -> DataFrame:
    return df.withColumns({f"{c}_log": F.log1p(_d(c)) for c in cols if c in df.columns})


def interaction_features(df: DataFrame) -> DataFrame:
    out = {}
    if {"defect_rates", "production_volumes"} <= set(df.columns):
        out["defect_production_interaction"] = _d("defect_rates") * _d("production_volumes")
    if {"price", "order_quantities"} <= set(df.columns):
        out["price_order_interaction"] = _d("price") * _d("order_quantities")
    return df.withColumns(out) if out else df


def ratio_features(df: DataFrame) -> DataFrame:
    out = {}
    if {"revenue_generated", "costs"} <= set(df.columns):
        out["profit_margin"] = (_d("revenue_generated") - _d("costs")) / zero_to_one("revenue_generated")
    if {"stock_levels", "order_quantities"} <= set(df.columns):
        out["inventory_turnover_ratio"] = _d("order_quantities") / zero_to_one("stock_levels")
    return df.withColumns(out) if out else df


def squared_features(df: DataFrame, cols=SQUARED_FEATURES) -> DataFrame:
    return df.withColumns({f"{c}_squared": _d(c) * _d(c) for c in cols if c in df.columns})


def efficiency_feature(df: DataFrame) -> DataFrame:
    if "manufacturing_lead_time" not in df.columns:
        return df
    return df.withColumn("manufacturing_efficiency", _d("production_volumes") / zero_to_one("manufacturing_lead_time"))


def cut(x: Column, edges: list[float], labels: list[str]) -> Column:
    """``pd.cut``: right-closed bins (a, b]; the lowest edge excluded; values
    outside every bin are NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def qcut_edges(df: DataFrame, col: str, q: int = 4) -> list[float]:
    edges = exact_quantiles(df, [col], [i / q for i in range(q + 1)])[col]
    if any(e is None for e in edges):
        raise ValueError(f"{col}: no values to bin")
    if len(set(edges)) != len(edges):
        raise ValueError(f"{col}: bin edges must be unique: {edges}")
    return edges


def qcut(x: Column, edges: list[float], labels: list[str]) -> Column:
    """``pd.qcut`` on precomputed edges: right-closed, lowest edge included."""
    expr = F.when((x >= edges[0]) & (x <= edges[1]), labels[0])
    for lo, hi, lab in zip(edges[1:-1], edges[2:], labels[1:]):
        expr = expr.when((x > lo) & (x <= hi), lab)
    return expr


def bin_features(df: DataFrame) -> DataFrame:
    out = {}
    if "defect_rates" in df.columns:
        out["defect_rate_category"] = cut(_d("defect_rates"), DEFECT_BIN_EDGES, DEFECT_BIN_LABELS)
    if "production_volumes" in df.columns:
        edges = qcut_edges(df, "production_volumes")
        out["production_volume_category"] = qcut(_d("production_volumes"), edges, VOLUME_QUARTILE_LABELS)
    return df.withColumns(out) if out else df


# ---- target encodings -----------------------------------------------------

def encoding_tables(df: DataFrame, cols: list[str], target: str = TARGET) -> DataFrame:
    """Long table (key, value, mean target) for every column in one pass."""
    parts = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"), F.col(target).alias("t"))
             for c in cols]
    return (df.select(F.explode(F.array(*parts)).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
            .groupBy("key", "value").agg(mean("t").alias("m")))


def target_encode(df: DataFrame, cols: list[str] | None = None, target: str = TARGET,
                  exclude=("sku",), suffix: str = "_lead_time_mean", fit_on: str | None = None) -> DataFrame:
    """Add ``{c}{suffix}`` = mean target of the row's category, per column.

    Encodings use every row (as the reference does, before the split), or
    with ``fit_on="train"`` only the rows whose ``split`` is that value."""
    cols = [c for c in (cols or string_columns(df)) if c not in exclude]
    if not cols:
        return df
    fit = df if fit_on is None else df.where(F.col("split") == fit_on)
    enc = materialise(encoding_tables(fit, cols, target), "encodings", by="key")
    return _encoded(df, enc, cols, suffix)


def _encoded(df: DataFrame, enc: DataFrame, cols: list[str], suffix: str = "_lead_time_mean") -> DataFrame:
    """``df`` joined to the encodings of ``cols``."""
    out = df
    for c in cols:
        t = with_value(enc, "key", c).select(F.col("value").alias(f"__{c}"), F.col("m").alias(f"{c}{suffix}"))
        out = join_lookup(out, t, F.col(c).cast("string") == F.col(f"__{c}"), "left").drop(f"__{c}")
    return out


def encoding_view(df: DataFrame, key: str, target: str = TARGET) -> DataFrame:
    """SQL view ``{key}_encoding``: mean target per key."""
    return df.groupBy(key).agg(mean(target).alias(f"{key}_lead_time_mean"))


def encoded_fact(df: DataFrame, keys=("product_type", "location", "sku")) -> DataFrame:
    """The fact with the three SQL encodings left-joined (supply_chain_encoded)."""
    return target_encode(df, list(keys), exclude=())


def written_encoded_fact(df: DataFrame, keys=("product_type", "location", "sku"), part_rows: int = PART_ROWS) -> DataFrame:
    """``encoded_fact``, written in parts of the last key, for whose encodings the
    rows are shuffled."""
    enc = materialise(encoding_tables(df, list(keys), TARGET), "encodings", by="key")
    parts = parts_of(df.count(), part_rows)
    out = materialise_parts(df.sparkSession, [_encoded(df.where(in_part(keys[-1], k, parts)), enc, list(keys))
                                              for k in range(parts)], "encoded-fact")
    discard(enc)
    return out


def transport_mode_code(c: str = "transportation_modes") -> Column:
    expr = None
    for k, v in TRANSPORT_CODES:
        expr = F.when(F.col(c) == k, v) if expr is None else expr.when(F.col(c) == k, v)
    return expr.otherwise(0)


def inspection_score(c: str = "inspection_results") -> Column:
    expr = None
    for k, v in INSPECTION_SCORES:
        expr = F.when(F.col(c) == k, v) if expr is None else expr.when(F.col(c) == k, v)
    return expr.otherwise(0.5).cast("double")


def ml_ready(df: DataFrame) -> DataFrame:
    """The flat export relation (ml_ready_data)."""
    enc = encoded_fact(df)
    return enc.select(
        "sku", "product_type", _d("price").alias("price"), _d("defect_rates").alias("defect_rates"),
        "production_volumes", _d("manufacturing_costs").alias("manufacturing_costs"),
        _d("shipping_costs").alias("shipping_costs"), "lead_time", "product_type_lead_time_mean",
        "location_lead_time_mean", "sku_lead_time_mean", transport_mode_code().alias("transport_mode_code"),
        inspection_score().alias("inspection_score"))


def export(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a relation as parquet (overwrite), optionally partitioned."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


# ---- scaling --------------------------------------------------------------

def _moments(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std of each column: one aggregate, one row."""
    return df.agg(*[x for c in cols for x in (mean(c).alias(f"mu_{c}"), F.stddev_pop(_d(c)).alias(f"sd_{c}"))]) \
        .first().asDict()


def zscore_features(df: DataFrame, features=ZSCORE_FEATURES) -> DataFrame:
    """(x - mean) / population std (NULL for a constant column), the moments
    from one aggregate pass; lead_time kept raw."""
    st = _moments(df, [c for c, _ in features])
    return df.select("sku", *[F.try_divide(_d(c) - F.lit(st[f"mu_{c}"]), F.lit(st[f"sd_{c}"]).cast("double"))
                              .alias(z) for c, z in features], "lead_time")


def standard_scale(df: DataFrame, cols=CLUSTER_FEATURES, keep=("sku",)) -> DataFrame:
    """StandardScaler: population std; a constant column scales by 1."""
    st = _moments(df, list(cols))
    sd = lambda c: F.lit(st[f"sd_{c}"] or 1.0)
    return df.select(*keep, *[((_d(c) - F.lit(st[f"mu_{c}"])) / sd(c)).alias(f"{c}_scaled") for c in cols])


# ---- all feature steps ----------------------------------------------------

def engineer(df: DataFrame) -> DataFrame:
    """All feature steps in the reference's order (24 -> 45 columns)."""
    out = log_features(df)
    out = target_encode(out)
    out = interaction_features(out)
    out = ratio_features(out)
    out = squared_features(out)
    out = bin_features(out)
    return efficiency_feature(out)
