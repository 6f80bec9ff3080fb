"""Registry of named queries: Spark callable + DuckDB oracle text.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole fact relation.  The thresholds used for the registered queries
are chosen once so that every filter stays selective on the driver's
tables (the reference's defaults would keep all or none of the groups);
the library functions keep the reference's values as defaults.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import strip_title
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import knn as K
from ..operators import quality as Q
from ..operators import split as SP
from ..operators.sparse import one_hot_drop_first
from ..operators import reports as R
from ..operators import stats as S
from ..session import ensure_checkpoint_dir, materialise
from ..sources.fact import base_columns, fact, written_items
from .oracle_eda import eda_sql
from .ml_catalog import ml_queries, ml_sql
from .oracle_sources import source_sql
from .oracle_features import KNN_FEATURES, features_sql
from .oracle_reports import report_sql

# Registered thresholds (the survey's selective values for the test tables).
PARAMS = {
    "min_orders": 600,        # HAVING COUNT(*) > 5 in the script
    "location_avg": 15.5,     # HAVING AVG(lead_time) > 18
    "supplier_defect": 2.5,   # HAVING AVG(defect_rates) > 2.5
    "listed": 20,             # items named per section of the text summary (a top-k report)
    "premium_price": 950,     # price > 60
    "lead_threshold": 20,     # lead_time > 20
}

Query = Callable[[SparkSession, str], DataFrame]


def _on_fact(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fact(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    return run


def report_queries() -> dict[str, Query]:
    p = PARAMS
    return {
        "overview": _on_fact(R.overview),
        "product_type_brief": _on_fact(R.product_type_brief),
        "null_counts": _on_fact(R.null_counts),
        "target_range": _on_fact(R.target_range),
        "lead_time_bins": _on_fact(R.lead_time_bins),
        "correlation_moments": _on_fact(R.correlation_moments),
        "product_type_stats": _on_fact(R.product_type_stats),
        "by_location": _on_fact(R.by_location),
        "by_mode": _on_fact(R.by_mode),
        "by_supplier": _on_fact(R.by_supplier, min_orders=p["min_orders"]),
        "by_mode_route": _on_fact(R.by_mode_route),
        "by_demographics": _on_fact(R.by_demographics),
        "volume_band": _on_fact(R.volume_band),
        "product_by_location": _on_fact(R.product_by_location),
        "monthly_snapshot": _on_fact(R.monthly_snapshot),
        "high_lead_time": _on_fact(R.high_lead_time, threshold=p["lead_threshold"]),
        "high_defect": _on_fact(R.high_defect),
        "bottleneck_class": _on_fact(R.bottleneck_class, premium_price=str(p["premium_price"])),
        "recommendation_text": _on_fact(lambda f: R.recommendation_text(R.recommendation_items(
            f, location_avg=p["location_avg"], supplier_defect=p["supplier_defect"]), p["listed"])),
        "recommendation_summary": _on_fact(R.recommendation_items, location_avg=p["location_avg"],
                                           supplier_defect=p["supplier_defect"]),
    }


def _on_base(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(base_columns(fact(spark, sf_dir)), **kw)
    run.__name__ = fn.__name__
    return run


def _on_gaps(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Q.with_gaps(fact(spark, sf_dir)), **kw)
    run.__name__ = fn.__name__
    return run


CATEGORY_COLS = ["product_type", "customer_demographics", "shipping_carriers", "location",
               "transportation_modes", "routes"]


def eda_queries() -> dict[str, Query]:
    return {
        "missing_profile": _on_gaps(Q.missing_profile),
        "duplicate_count": _on_base(Q.duplicate_count),
        "category_audit": _on_base(Q.category_audit),
        "drop_sparse_columns": _on_gaps(Q.drop_sparse_columns),
        "impute_median_mode": _on_gaps(lambda g: Q.impute(Q.drop_sparse_columns(g))),
        # the rows above 20 days occur twice in the input
        "dedupe": _on_base(lambda b: Q.dedupe(b.unionAll(b.where("lead_time > 20")))),
        "distinct_categories": _on_base(lambda b: Q.dedupe(b.select(*CATEGORY_COLS))),
        "standardise_text": _on_gaps(lambda g: g.select(
            "sku", strip_title("inspection_results").alias("inspection_results"),
            strip_title("transportation_modes").alias("transportation_modes"))),
        "cleaned_table": _on_gaps(Q.clean),
        "describe_numeric": _on_base(S.describe),
        "mean_median": _on_base(S.mean_median),
        "histogram20": _on_base(S.histogram),
        "box_summary": _on_base(S.box_summary),
        "correlation_matrix": _on_base(S.correlation_matrix),
        "target_correlations_top": _on_base(S.target_correlations),
        "target_correlations_bottom": _on_base(S.target_correlations, bottom=True),
        "correlation_lower_triangle": _on_base(S.correlation_lower_triangle),
        "value_counts_top10": _on_base(S.value_counts_top),
        "frequency_in_key_order": _on_base(lambda b: S.frequency(b, "supplier_name", by_key=True)),
        "category_mean_top10": _on_base(S.category_mean_top),
    }


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def split_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU-grain items with their train/test split (seed 42, 20 % test,
    stratified by product type)."""
    # the split runs several jobs over the items: materialise them once
    return SP.stratified_split(written_items(fact(spark, sf_dir)))


def knn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the neighbour search runs several jobs over its input: materialise it once
    s = materialise(split_items(spark, sf_dir).withColumn("label", F.col("lead_time")), "split-items")
    train = s.where(F.col("split") == "train")
    pred = K.knn_regress(train, s, KNN_FEATURES, k=5)
    return s.select("sku", "split", "label").join(pred, "sku")


def overfit(metrics: DataFrame) -> DataFrame:
    """(train_r2, test_r2, overfit %) from the two metric rows, pivoted by
    one aggregate."""
    r2 = lambda s: F.max(F.when(F.col("split") == s, F.col("r2")))
    return metrics.agg(r2("train").alias("train_r2"), r2("test").alias("test_r2")).select(
        "train_r2", "test_r2", F.when(F.col("train_r2") == 0, F.lit(0.0)).otherwise(
            F.round((F.col("train_r2") - F.col("test_r2")) / F.col("train_r2") * 100, 6)).alias("overfit_pct"))


def _feature_width(base: DataFrame) -> DataFrame:
    """Columns before / after the feature stage, and the rows it keeps."""
    eng = FE.engineer(base)
    return eng.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(len(base.columns)).alias("columns_before"), F.lit(len(eng.columns)).alias("columns_after"), "rows")


def feature_queries() -> dict[str, Query]:
    return {
        "log_features": _on_base(lambda b: _round(FE.log_features(b).select(
            "sku", "production_volumes_log", "costs_log", "revenue_generated_log"),
            ["production_volumes_log", "costs_log", "revenue_generated_log"])),
        "interaction_features": _on_base(lambda b: FE.interaction_features(b).select(
            "sku", "defect_production_interaction", "price_order_interaction")),
        "ratio_features": _on_base(lambda b: FE.ratio_features(b).select(
            "sku", "profit_margin", "inventory_turnover_ratio")),
        "squared_features": _on_base(lambda b: FE.squared_features(b).select(
            "sku", "defect_rates_squared", "production_volumes_squared", "price_squared")),
        "cut_bins": _on_base(lambda b: b.select(
            "sku", F.col("defect_rates").cast("double").alias("defect_rates"),
            FE.cut(F.col("defect_rates").cast("double"), FE.DEFECT_BIN_EDGES, FE.DEFECT_BIN_LABELS)
            .alias("defect_rate_category"))),
        "quartile_bins": _on_base(lambda b: FE.bin_features(b.drop("defect_rates")).select(
            "sku", F.col("production_volumes").cast("double").alias("production_volumes"),
            "production_volume_category")),
        "efficiency": _on_base(lambda b: FE.efficiency_feature(b).select("sku", "manufacturing_efficiency")),
        "target_encode_all": _on_base(lambda b: FE.target_encode(b).select(
            "sku", *[f"{c}_lead_time_mean" for c in Q.string_columns(b) if c != "sku"])),
        "encode_product_type": _on_base(lambda b: FE.encoding_view(b, "product_type")),
        "encode_location": _on_base(lambda b: FE.encoding_view(b, "location")),
        "encode_sku": _on_base(lambda b: FE.encoding_view(b, "sku")),
        "encoded_fact": _on_base(FE.written_encoded_fact),
        "ml_ready": _on_base(FE.ml_ready),
        "zscore_features": _on_base(lambda b: _round(FE.zscore_features(b),
                                                     ["defect_rate_z", "production_volume_z", "price_z",
                                                      "shipping_cost_z"])),
        "standard_scale": _on_base(lambda b: _round(FE.standard_scale(b), [
            f"{c}_scaled" for c in FE.CLUSTER_FEATURES])),
        "feature_matrix_width": _on_base(_feature_width),
        "one_hot_drop_first": lambda spark, sf: one_hot_drop_first(
            FE.bin_features(written_items(fact(spark, sf)))),
        "sku_items": lambda spark, sf: written_items(fact(spark, sf)),
        "stratified_split": lambda spark, sf: split_items(spark, sf).select("sku", "product_type", "split"),
        "split_sizes": lambda spark, sf: split_items(spark, sf).groupBy("split", "product_type").agg(
            F.count(F.lit(1)).alias("n")),
        "knn_regression": lambda spark, sf: _round(knn_predictions(spark, sf), ["prediction"]),
        "regression_metrics": lambda spark, sf: K.regression_metrics(knn_predictions(spark, sf), by=["split"]),
        "overfit_pct": lambda spark, sf: overfit(K.regression_metrics(knn_predictions(spark, sf), by=["split"])),
    }


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.csv import read_supply_chain_csv, write_supply_chain_csv
    from ..sources.fact import completed, fact_path
    path = completed(spark, f"{fact_path(spark, sf_dir)}_csv",
                     lambda to: write_supply_chain_csv(base_columns(fact(spark, sf_dir)), to))
    return read_supply_chain_csv(spark, path)


def _stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.fact import fact_path
    from ..streaming.monthly import run_monthly_snapshot
    fact(spark, sf_dir)  # make sure the fact files exist
    work = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream_{uuid.uuid4().hex}"
    return run_monthly_snapshot(spark, fact_path(spark, sf_dir), work, files_per_batch=2)


def _ml_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export relation, written by product type and read back."""
    rows = FE.ml_ready(base_columns(fact(spark, sf_dir)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ml_export_{uuid.uuid4().hex}"
    FE.export(rows, path, partition_by="product_type")
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def _sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL report on the export view, itself a view on the encoding views."""
    from ..sources.catalog import register_views
    register_views(fact(spark, sf_dir))
    return spark.sql(SQL_VIEWS.format(view="ml_ready_data"))


#: Report on the export view, in Spark's and DuckDB's SQL alike.
SQL_VIEWS = ("SELECT product_type, transport_mode_code, count(*) AS rows, cast(sum(lead_time) AS bigint) AS lead_time_sum, "
             "round(max(product_type_lead_time_mean), 6) AS type_mean FROM {view} GROUP BY product_type, transport_mode_code")


def source_queries() -> dict[str, Query]:
    from ..sources.catalog import typed
    from ..schema import FACT_COLUMNS
    base_cols = [n for n, _ in FACT_COLUMNS]
    return {
        "fact_typed": _on_base(lambda b: b),
        "typed_table": _on_base(typed),
        "ml_export": _ml_export,
        "sql_views": _sql_views,
        "dtype_counts": _on_base(Q.dtype_counts),
        "shape": _on_base(lambda b: b.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(b.columns)).alias("columns"))),
        "head_rows": _on_base(lambda b: b.orderBy(*base_cols).limit(5)),
        "csv_roundtrip": _csv_roundtrip,
        "monthly_snapshot_stream": _stream_snapshot,
    }


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(report_queries())
    out.update(eda_queries())
    out.update(feature_queries())
    out.update(ml_queries())
    out.update(source_queries())
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(report_sql(PARAMS))
    out.update(eda_sql())
    out.update(features_sql())
    out.update(ml_sql())
    out.update(source_sql())
    out["ml_export"] = out["ml_ready"]
    out["sql_views"] = SQL_VIEWS.format(view=f"({out['ml_ready']}) AS v")
    return out
