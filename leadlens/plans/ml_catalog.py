"""Registered model, explanation, clustering and insight queries.

These run on the SKU-grain items derived from the whole fact relation.
Fitted models and the checkpointed design matrix are memoised per
(session, data folder) so that queries sharing a model fit it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import explain as EX
from ..operators import insights as IN
from ..operators import linear as LI
from ..operators import models as MO
from ..operators.stats import target_correlations_all
from ..schema import TARGET
from ..session import materialise
from ..sources.fact import base_columns, fact, fact_path, written_items
from .oracle_features import items_ctes
from .oracle_fact import with_fact

_memo: dict = {}


def _get(spark: SparkSession, sf_dir: str, what: str, build):
    # the written fact's folder changes with the source files
    k = (spark.sparkContext.applicationId, fact_path(spark, sf_dir), what)
    for old in [x for x in _memo if x[0] != k[0]]:   # of an ended application
        del _memo[old]
    if k not in _memo:
        _memo[k] = build()
    return _memo[k]


def _items(spark, sf):
    return _get(spark, sf, "items", lambda: written_items(fact(spark, sf)))


def _design(spark, sf):
    return _get(spark, sf, "design", lambda: MO.design(_items(spark, sf)))


def _fit(spark, sf, model):
    """(fitted model or None for KNN, predictions for every item)."""
    def build():
        m, pred = MO.fit_predict(_design(spark, sf), model)
        return m, materialise(pred, "predictions")
    return _get(spark, sf, f"fit:{model}", build)


def _metrics_rows(spark, sf, model):
    def build():
        from ..operators.knn import regression_metrics
        _, pred = _fit(spark, sf, model)
        return [(model, *tuple(r)) for r in regression_metrics(pred, by=["split"]).collect()]
    return _get(spark, sf, f"metrics:{model}", build)


def _metrics_df(spark, sf, models):
    rows = [r for m in models for r in _metrics_rows(spark, sf, m)]
    return spark.createDataFrame(rows, "model string, split string, n bigint, rmse double, r2 double, mae double")


def _forest(spark, sf):
    return _fit(spark, sf, "Random Forest")[0]


def _tree(spark, sf):
    return _get(spark, sf, "tree", lambda: MO.bottleneck_tree(_design(spark, sf)))


def _attributions(spark, sf):
    def build():
        d = _design(spark, sf)
        test = d.rows.where(F.col("split") == "test")
        return materialise(EX.attributions(_forest(spark, sf), test, d.names, spark), "attributions")
    return _get(spark, sf, "attr", build)


def _cluster_vec(spark, sf):
    return _get(spark, sf, "cvec", lambda: CL.cluster_matrix(_items(spark, sf)))


def _assigned(spark, sf):
    def build():
        a, _ = CL.assign(_cluster_vec(spark, sf))
        return materialise(a, "assigned")
    return _get(spark, sf, "assign", build)


def _profile(spark, sf):
    return CL.cluster_profile(_items(spark, sf), _assigned(spark, sf))


#: Columns of the linear models that are solved on the moment matrix.
RIDGE_FEATURES = ["price", "defect_rates"]
LASSO_FEATURES = ["price", "stock_levels", "order_quantities", "production_volumes", "defect_rates", "shipping_costs"]

#: Centres of the segments that are reported without a fit.
SEGMENT_CENTRES = [{"lead_time": 14.0, "price": 915.0}, {"lead_time": 15.0, "price": 940.0},
                   {"lead_time": 16.0, "price": 965.0}, {"lead_time": 15.0, "price": 990.0}]


def _segments_sql(columns: str, order: str) -> str:
    """Items with the number of their nearest centre, grouped."""
    apart = [" + ".join(f"(cast({c} AS double) - {v}) * (cast({c} AS double) - {v})" for c, v in at.items())
             for at in SEGMENT_CENTRES]
    d = ", ".join(f"{x} AS d{k}" for k, x in enumerate(apart))
    least = f"least({', '.join(f'd{k}' for k in range(len(apart)))})"
    case = " ".join(f"WHEN d{k} = {least} THEN {k}" for k in range(len(apart)))
    return with_fact(f"SELECT {columns} FROM seg GROUP BY cluster ORDER BY {order}", *items_ctes(),
                     f"seg AS (SELECT *, cast(CASE {case} END AS int) AS cluster FROM (SELECT *, {d} FROM items))")


MODEL_KEYS = {
    "ols": "Linear Regression", "ridge": "Ridge Regression", "lasso": "Lasso Regression",
    "decision_tree": "Decision Tree", "random_forest": "Random Forest", "gbt": "Gradient Boosting",
    "gbt_deep": "Gradient Boosting (deep)", "knn_model": "KNN",
}


def _model_query(name):
    return lambda spark, sf: _metrics_df(spark, sf, [name])


def ml_queries() -> dict:
    q = {k: _model_query(v) for k, v in MODEL_KEYS.items()}
    q["leaderboard"] = lambda spark, sf: MO.leaderboard(_metrics_df(spark, sf, MO.MODEL_NAMES))
    q["tree_importance"] = lambda spark, sf: MO.importances(_tree(spark, sf), _design(spark, sf).names)
    q["tree_rules"] = lambda spark, sf: MO.tree_rules(_tree(spark, sf), _design(spark, sf).names, spark)
    q["leaf_patterns"] = lambda spark, sf: MO.leaf_patterns(_tree(spark, sf), _design(spark, sf))
    q["literal_patterns"] = lambda spark, sf: IN.decision_patterns(fact(spark, sf))
    q["tree_attributions"] = lambda spark, sf: _attributions(spark, sf)
    q["attribution_ranking"] = lambda spark, sf: EX.attribution_ranking(
        _attributions(spark, sf), _design(spark, sf).rows.where(F.col("split") == "test").count())
    q["attribution_dependence"] = lambda spark, sf: EX.dependence(
        _attributions(spark, sf), MO.importances(_tree(spark, sf), _design(spark, sf).names))

    def sample(spark, sf):
        attr = _attributions(spark, sf)
        first = attr.agg(F.min("sku").alias("k")).first().k
        return EX.sample_explanation(attr, first)
    q["sample_explanation"] = sample
    q["ridge_two_features"] = lambda spark, sf: LI.fit_on_moments(
        base_columns(fact(spark, sf)), RIDGE_FEATURES, TARGET, ridge=1.0)
    q["lasso_on_moments"] = lambda spark, sf: LI.fit_on_moments(
        base_columns(fact(spark, sf)), LASSO_FEATURES, TARGET, lasso=0.01)
    q["cluster_features"] = lambda spark, sf: _items(spark, sf).select("sku", *CL.CLUSTER_FEATURES)
    q["kmeans_sweep"] = lambda spark, sf: CL.kmeans_sweep(_cluster_vec(spark, sf))
    q["cluster_assign"] = lambda spark, sf: _assigned(spark, sf)
    q["cluster_means"] = lambda spark, sf: CL.cluster_means(_items(spark, sf), _assigned(spark, sf))
    q["cluster_profile"] = _profile
    q["cluster_bottleneck"] = lambda spark, sf: _profile(spark, sf).select("cluster", "primary_bottleneck")
    # the same reports over an assignment that SQL can make: the nearest of given centres
    q["segment_means"] = lambda spark, sf: CL.cluster_means(
        _items(spark, sf), CL.nearest_centre(_items(spark, sf), SEGMENT_CENTRES))
    q["segment_means_half_even"] = lambda spark, sf: CL.cluster_means(
        _items(spark, sf), CL.nearest_centre(_items(spark, sf), SEGMENT_CENTRES), digits=2, half_even=True)
    q["segment_profile"] = lambda spark, sf: CL.cluster_profile(
        _items(spark, sf), CL.nearest_centre(_items(spark, sf), SEGMENT_CENTRES))
    q["segment_profile_without_prices"] = lambda spark, sf: CL.cluster_profile(
        _items(spark, sf).drop("price", "product_type", "defect_rates"),
        CL.nearest_centre(_items(spark, sf), SEGMENT_CENTRES))
    q["pca_2d"] = lambda spark, sf: CL.pca_2d(_cluster_vec(spark, sf), _assigned(spark, sf))[0]
    q["insight_rules"] = lambda spark, sf: IN.insight_rules(
        target_correlations_all(base_columns(fact(spark, sf))),
        MO.importances(_tree(spark, sf), _design(spark, sf).names), _profile(spark, sf))
    return q


def ml_sql() -> dict:
    cf = ", ".join(f"{c}" for c in CL.CLUSTER_FEATURES)
    conds = [("defect_rates > 2.1 AND price > 62.97", "defect_rates > 2.1 AND price > 62.97",
              "High defect rates combined with premium pricing cause severe delays",
              "Improve quality control for premium SKUs"),
             ("defect_rates <= 0.4 AND price <= 29.73", "defect_rates <= 0.4 AND price <= 29.73",
              "Low-cost, high-quality items are processed quickly", "Replicate this process for other products"),
             ("production_volumes > 700", "production_volumes > 700", "High production volumes create bottlenecks",
              "Implement batch processing or increase capacity")]
    parts = [f"SELECT '{c}' AS condition, count(*) FILTER (WHERE {w}) AS rows, "
             f"cast(sum(lead_time) FILTER (WHERE {w}) AS double) / nullif(count(*) FILTER (WHERE {w}), 0) "
             f"AS avg_lead_time, '{t}' AS interpretation, '{r}' AS recommendation FROM fact"
             for c, w, t, r in conds]
    avg = lambda c, name: f"round(cast(sum({c}) AS double) / count({c}), 6) AS {name}"
    label = lambda d: (f"CASE {d}WHEN sum(production_volumes) / count(production_volumes) > 700 THEN 'Production Volume' "  # noqa: E731
                       "WHEN sum(lead_time) / count(lead_time) > 20 THEN 'Logistics' ELSE 'Efficient' END AS primary_bottleneck")
    head = f"cluster, count(*) AS count, {avg('lead_time', 'avg_lead_time')}, "
    modal = ("(SELECT product_type FROM seg t WHERE t.cluster = seg.cluster GROUP BY product_type "
             "ORDER BY count(*) DESC, product_type LIMIT 1) AS product_types")
    x1, x2 = RIDGE_FEATURES
    ridge = [f"m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, count(*) * covar_pop(a, a) + 1 AS aa, "
             f"count(*) * covar_pop(b, b) + 1 AS bb, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, y) AS ya, "
             f"count(*) * covar_pop(b, y) AS yb FROM (SELECT cast({x1} AS double) AS a, cast({x2} AS double) AS b, "
             f"cast({TARGET} AS double) AS y FROM fact) WHERE a IS NOT NULL AND b IS NOT NULL AND y IS NOT NULL)",
             "w AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS wa, "
             "(yb * aa - ya * ab) / (aa * bb - ab * ab) AS wb FROM m)"]
    return {
        "ridge_two_features": with_fact(
            f"SELECT '{x1}' AS feature, round(wa, 6) AS coefficient FROM w UNION ALL SELECT '{x2}', round(wb, 6) FROM w "
            "UNION ALL SELECT 'intercept', round(my - wa * ma - wb * mb, 6) FROM w", *ridge),
        "segment_means": _segments_sql(
            "cluster, count(*) AS count, " + ", ".join(avg(c, c) for c in CL.CLUSTER_FEATURES), "cluster"),
        "segment_means_half_even": _segments_sql(
            "cluster, count(*) AS count, " + ", ".join(
                f"round_even(cast(sum({c}) AS double) / count({c}), 2) AS {c}" for c in CL.CLUSTER_FEATURES), "cluster"),
        "segment_profile": _segments_sql(
            head + f"{avg('defect_rates', 'avg_defect_rate')}, {avg('production_volumes', 'avg_production_volume')}, "
            f"{avg('price', 'avg_price')}, {modal}, "
            + label("WHEN sum(defect_rates) / count(defect_rates) > 2.5 THEN 'Quality Issues' "), "avg_lead_time DESC"),
        "segment_profile_without_prices": _segments_sql(
            head + f"cast(NULL AS double) AS avg_defect_rate, {avg('production_volumes', 'avg_production_volume')}, "
            f"cast(NULL AS double) AS avg_price, 'N/A' AS product_types, " + label(""), "avg_lead_time DESC"),
        "cluster_features": with_fact(f"SELECT sku, {cf} FROM items", *items_ctes()),
        "literal_patterns": with_fact(" UNION ALL ".join(parts)),
    }
