"""Regression models, metrics, leaderboard and the bottleneck tree (Spark ML, and
trees.py and forest.py for trees, boosted trees and forests).

The design matrix is assembled once and checkpointed to the shared
checkpoint folder: every fit reads it many times, and a lost executor then
re-reads files instead of re-running the feature stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import forest, trees
from ..session import discard, materialise
from .features import engineer
from .knn import knn_regress, regression_metrics
from .sparse import Design, design_matrix
from .split import stratified_split

SEED = 42


def design(items_df: DataFrame, seed: int = SEED) -> Design:
    """The design matrix of the SKU-grain items, with the split.  Encodings and
    bins use all rows, then the split."""
    # each stage below runs several small jobs over its input: cut lineage
    base = items_df if hasattr(items_df, "written_at") else materialise(items_df, "items")
    whole = materialise(engineer(base), "engineered")
    d = design_matrix(stratified_split(whole, seed=seed), keep=("split",))
    discard(whole, *([] if base is items_df else [base]))
    return d


def estimators(train: DataFrame) -> dict:
    """The regressors.  Ridge's penalty is rescaled to Spark's objective:
    regParam = alpha * std_pop(y) / n.  Least squares and ridge solve the
    normal equations up to 4,096 features and descend on the gradient, whose
    size is the number of features, beyond (Spark's "auto")."""
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("sd")).first()
    n, sd = st.n, st.sd or 1.0
    common = dict(featuresCol="features", labelCol="label")
    return {
        "Linear Regression": LinearRegression(regParam=0.0, solver="auto", **common),
        "Ridge Regression": LinearRegression(regParam=1.0 * sd / n, elasticNetParam=0.0, standardization=False,
                                             solver="auto", **common),
        "Lasso Regression": LinearRegression(regParam=0.1, elasticNetParam=1.0, standardization=False, **common),
    }


#: Tree models that are grown on the sparse rows.
TREES = {"Decision Tree": dict(max_depth=5),
         "Gradient Boosting": dict(max_depth=3, rounds=100, step=0.1),
         "Gradient Boosting (deep)": dict(max_depth=6, rounds=100, step=0.3)}
FORESTS = {"Random Forest": dict(n_trees=100, max_depth=30)}


def fit_predict(d: Design, model: str):
    """Fit one named model on the train split; predictions for all rows."""
    train = d.rows.where(F.col("split") == "train")
    if model == "KNN":
        pred = knn_regress(train, d.rows, F.col("dense"), k=5, codes=F.col("codes"))
        return None, d.rows.select("sku", "split", "label").join(pred, "sku")
    m = (trees.fit(train, d.width, seed=SEED, **TREES[model]) if model in TREES
         else forest.fit(train, d.width, seed=SEED, **FORESTS[model]) if model in FORESTS
         else estimators(train)[model].fit(train))
    return m, m.transform(d.rows).select("sku", "split", "label", "prediction")


MODEL_NAMES = ["Linear Regression", "Ridge Regression", "Lasso Regression", "Decision Tree", "Random Forest",
               "Gradient Boosting", "Gradient Boosting (deep)", "KNN"]


def model_metrics(d: Design, model: str) -> DataFrame:
    _, pred = fit_predict(d, model)
    return regression_metrics(pred, by=["split"]).select(F.lit(model).alias("model"), "*")


def leaderboard(metrics: DataFrame) -> DataFrame:
    """One row per model: train/test RMSE, R², MAE and overfit %, by test R²."""
    t = metrics.where(F.col("split") == "train").select(
        "model", *[F.col(c).alias(f"train_{c}") for c in ("rmse", "r2", "mae")])
    s = metrics.where(F.col("split") == "test").select(
        "model", *[F.col(c).alias(f"test_{c}") for c in ("rmse", "r2", "mae")])
    j = t.join(s, "model")
    over = F.when(F.col("train_r2") == 0, F.lit(0.0)).otherwise(
        F.round((F.col("train_r2") - F.col("test_r2")) / F.col("train_r2") * 100, 6))
    return j.select("model", "train_rmse", "test_rmse", "train_r2", "test_r2", "train_mae", "test_mae",
                    over.alias("overfit_pct")).orderBy(F.desc("test_r2"))


def all_metrics(d: Design, models=MODEL_NAMES) -> DataFrame:
    return reduce(DataFrame.unionByName, [model_metrics(d, m) for m in models])


# ---- bottleneck tree -------------------------------------------------------

def bottleneck_tree(d: Design):
    """Depth 4, at least 5 rows per leaf (so at least 10 per split)."""
    train = d.rows.where(F.col("split") == "train")
    return trees.fit(train, d.width, max_depth=4, min_rows=5, seed=SEED)


def importances(model, names: DataFrame) -> DataFrame:
    """Impurity importances (sum 1) ranked, one row per feature; the model
    names only the features that it splits on."""
    imp = model.featureImportances
    used = names.sparkSession.createDataFrame(
        [(int(i), float(imp[int(i)])) for i in imp.indices], "feature int, importance double")
    return (names.join(used, "feature", "left")
            .select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def tree_rules(model, names: DataFrame, spark, limit: int | None = None) -> DataFrame:
    """Root-to-leaf rules as rows (leaf id, rule, depth, prediction, count),
    the first ``limit`` of them if given: the text dump re-aimed as a table.
    One self-join per tree level."""
    nodes = model.nodes(spark)
    edges = nodes.where(F.col("left") >= 0).join(names, "feature").select(
        "id", F.col("name").alias("fname"), "threshold", "left", "right")
    kids = (edges.select(F.col("left").alias("child"), F.col("id").alias("parent"),
                         F.format_string("%s <= %.2f", "fname", "threshold").alias("cond"))
            .unionByName(edges.select(F.col("right").alias("child"), F.col("id").alias("parent"),
                                      F.format_string("%s > %.2f", "fname", "threshold").alias("cond"))))
    root = nodes.agg(F.min("id").alias("id")).first().id
    paths = kids.where(F.col("parent") == root).select(
        F.col("child").alias("node"), F.array("cond").alias("conds"))
    frontier, done = paths, []
    for _ in range(model.getMaxDepth()):
        nxt = frontier.join(kids, frontier.node == kids.parent).select(
            F.col("child").alias("node"), F.concat("conds", F.array("cond")).alias("conds"))
        done.append(frontier)
        frontier = nxt
    allp = reduce(DataFrame.unionByName, done + [frontier])
    # leaf index as Spark's leafCol numbers them: leaves in pre-order (node id);
    # the node table is model metadata (at most 2^depth leaves)
    leaf_ids = sorted(r.id for r in nodes.where(F.col("left") < 0).select("id").collect())
    index = F.create_map(*[x for i, n in enumerate(leaf_ids) for x in (F.lit(n), F.lit(i))])
    leaves = nodes.where(F.col("left") < 0).withColumn("leaf", F.element_at(index, F.col("id")))
    rules = (allp.join(leaves, allp.node == leaves.id)
             .select("leaf", F.col("node").alias("node_id"), F.concat_ws(" AND ", "conds").alias("rule"),
                     F.size("conds").alias("depth"), F.round("prediction", 6).alias("prediction"), "count")
             .orderBy("leaf"))
    return rules if limit is None else rules.limit(limit)


def leaf_patterns(model, d: Design) -> DataFrame:
    """Observed rows and mean lead time per leaf, on each split."""
    return (model.transform(d.rows).groupBy("leaf", "split")
            .agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("label"), 6).alias("avg_lead_time"))
            .orderBy("leaf", "split"))
