"""Model, explanation and clustering invariants."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from leadlens.operators import cluster as CL
from leadlens.operators import explain as EX
from leadlens.operators import models as MO
from leadlens.operators import sparse as SP
from leadlens.sources.fact import fact, items

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def design(spark):
    return MO.design(items(fact(spark, SF_SMALL)))


def _cond_exp(tree, x, subset, j=0):
    """Path-dependent E[f(x) | x_S]: follow x on features in S, else weight
    children by training cover."""
    if tree["left"][j] < 0:
        return tree["value"][j]
    f, l, r = tree["feature"][j], tree["left"][j], tree["right"][j]
    if f in subset:
        return _cond_exp(tree, x, subset, l if x[f] <= tree["threshold"][j] else r)
    c = tree["cover"]
    return (c[l] * _cond_exp(tree, x, subset, l) + c[r] * _cond_exp(tree, x, subset, r)) / c[j]


def test_tree_shap_equals_brute_force_shapley(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4))
    y = 3 * (x[:, 0] > 0) + x[:, 1] * (x[:, 2] > 0.5) + rng.normal(0, 0.1, 200)
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    df = spark.createDataFrame([(Vectors.dense(list(map(float, a))), float(b)) for a, b in zip(x, y)], schema)
    m = DecisionTreeRegressor(maxDepth=5, seed=1).fit(df)     # features repeat on paths
    tree = EX.tree_arrays(EX.node_table(m, spark).toArrow())[0]
    feats = sorted({int(f) for f, l in zip(tree["feature"], tree["left"]) if l >= 0})
    rows = x[:6]
    phi = EX.tree_shap(tree, rows)
    n = len(feats)
    for i, row in enumerate(rows):
        for f in range(4):
            if f not in feats:
                assert phi[i, f] == 0.0
                continue
            others = [g for g in feats if g != f]
            want = 0.0
            for size in range(len(others) + 1):
                for s in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                    want += w * (_cond_exp(tree, row, set(s) | {f}) - _cond_exp(tree, row, set(s)))
            assert phi[i, f] == pytest.approx(want, abs=1e-9)


def test_forest_attributions_sum_to_prediction(spark, design):
    train = design.rows.where("split = 'train'")
    test = design.rows.where("split = 'test'")
    rf = RandomForestRegressor(numTrees=5, maxDepth=6, featureSubsetStrategy="all", seed=42).fit(train)
    attr = EX.attributions(rf, test, design.names, spark)
    s = attr.groupBy("sku").agg(F.sum("phi").alias("s"), F.first("base_value").alias("b"))
    err = (s.join(rf.transform(test).select("sku", "prediction"), "sku")
           .agg(F.max(F.abs(F.col("s") + F.col("b") - F.col("prediction")))).first()[0])
    assert err < 1e-6


def test_attributions_over_many_units(spark, design, monkeypatch):
    """Groups of trees and blocks of rows give what one unit gives."""
    train, test = (design.rows.where(f"split = '{s}'") for s in ("train", "test"))
    rf = RandomForestRegressor(numTrees=6, maxDepth=8, featureSubsetStrategy="all", seed=1).fit(train)
    whole = {(r.sku, r.feature): r.phi for r in EX.attributions(rf, test, design.names, spark).collect()}
    monkeypatch.setattr(EX, "GROUP_NODES", 50)
    monkeypatch.setattr(EX, "BLOCK_ROWS", 7)
    parts = {(r.sku, r.feature): r.phi for r in EX.attributions(rf, test, design.names, spark).collect()}
    assert parts.keys() == whole.keys() and all(abs(parts[k] - v) < 1e-9 for k, v in whole.items())


def test_ten_thousand_levels_are_fitted(spark):
    df = spark.range(25_000).select(
        F.concat(F.lit("s"), "id").alias("sku"), F.format_string("v%05d", F.col("id") % 10_000).alias("g"),
        (F.col("id") % 13).cast("double").alias("a"), ((F.col("id") % 10_000) / 100 + F.col("id") % 13).alias("lead_time"))
    d = SP.design_matrix(df)
    assert d.width == 10_000 and d.names.where("feature = 1").first().name == "g_v00001"
    model = LinearRegression(regParam=1e-3, solver="auto", maxIter=20, labelCol="label").fit(d.rows)
    assert model.coefficients.size == 10_000 and model.summary.r2 > 0.9
    row = d.rows.where("sku = 's10001'").first()
    assert row.features.indices.tolist() == [0, 1] and row.codes == [1]


def test_linear_models_order_and_tree_tables(spark, design):
    m = {r.model: r for r in MO.all_metrics(design, ["Linear Regression", "Ridge Regression",
                                                       "Lasso Regression", "Decision Tree"]).collect()
         if r.split == "train"}
    assert m["Linear Regression"].r2 >= 0
    assert m["Linear Regression"].r2 >= m["Ridge Regression"].r2 - 1e-9
    assert m["Linear Regression"].r2 >= m["Lasso Regression"].r2 - 1e-9
    tree = MO.bottleneck_tree(design)
    imp = MO.importances(tree, design.names)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0, abs=1e-9)
    rules = MO.tree_rules(tree, design.names, spark).collect()
    assert len(MO.tree_rules(tree, design.names, spark, limit=3).collect()) == min(3, len(rules))
    n_train = design.rows.where("split = 'train'").count()
    assert sum(r["count"] for r in rules) == n_train
    assert all(r.depth <= 4 and r["count"] >= 5 for r in rules)
    leaves = {(r.leaf, r.split): r.rows for r in MO.leaf_patterns(tree, design).collect()}
    assert {r.leaf: r["count"] for r in rules} == {lf: n for (lf, sp), n in leaves.items() if sp == "train"}


def test_clustering_invariants(spark):
    it = items(fact(spark, SF_SMALL))
    vec = CL.cluster_matrix(it)
    sweep = CL.kmeans_sweep(vec, ks=range(2, 6), restarts=3).collect()
    inertia = [r.inertia for r in sweep]
    assert all(b <= a * 1.01 for a, b in zip(inertia, inertia[1:]))
    assigned, centres = CL.assign(vec, k=4, restarts=3)
    a = assigned.collect()
    assert len(a) == it.count() and len({r.sku for r in a}) == len(a)
    assert sorted({r.cluster for r in a}) == [0, 1, 2, 3]
    assert centres == sorted(centres)
    prof = CL.cluster_profile(it, assigned).collect()
    assert sum(r["count"] for r in prof) == len(a)
    pcs, ratio = CL.pca_2d(vec)
    assert len(ratio) == 2 and ratio[0] >= ratio[1]


def _vectors(spark, x):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StringType, StructField, StructType
    return spark.createDataFrame([(f"s{i}", Vectors.dense(list(map(float, r)))) for i, r in enumerate(x)],
                                 StructType([StructField("sku", StringType()), StructField("features", VectorUDT())]))


def test_all_kmeans_fits_share_their_scans(spark, monkeypatch):
    """One scan per iteration for all fits; the inertia never rises and is that
    of the centres; the silhouette is Spark's."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from leadlens.operators import kmeans as KM
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.6, size=(60, 3)) for c in (0, 2, 5)] + [np.ones((40, 3))])
    vec = _vectors(spark, x).repartition(4).checkpoint()
    scans, step = [], KM._step
    monkeypatch.setattr(KM, "_step", lambda *a: scans.append(len(a[2])) or step(*a))
    fits = KM.fit_all(CL._points(vec), range(2, 6), 3, 42)
    assert len(fits) == 12 and scans[0] == 12 and len(scans) <= 21 and scans == sorted(scans, reverse=True)
    for f in fits:
        assert all(b <= a + 1e-9 for a, b in zip(f.inertia, f.inertia[1:]))
        assert f.inertia[-1] == pytest.approx(((x[:, None] - f.centres[None]) ** 2).sum(axis=2).min(axis=1).sum())
        assert f.counts.sum() == len(x)
    best = KM.best_by_k(fits)
    for k, s in zip(best, KM.silhouettes(CL._points(vec), list(best.values()))):
        own = ((x[:, None] - best[k].centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        mean = np.array([[((p - x[own == c]) ** 2).sum(axis=1).sum() for c in range(k)] for p in x])
        n = np.bincount(own, minlength=k)
        a = mean[np.arange(len(x)), own] / np.maximum(n[own] - 1, 1)
        mean = mean / n
        mean[np.arange(len(x)), own] = np.inf
        b = mean.min(axis=1)
        assert s == pytest.approx(np.where(n[own] > 1, (b - a) / np.maximum(a, b), 0).mean(), abs=1e-9)
        if k == 3:
            got = spark.createDataFrame([(Vectors.dense(p.tolist()), float(c)) for p, c in zip(x, own)], ["features", "prediction"])
            assert s == pytest.approx(ClusteringEvaluator().evaluate(got), abs=1e-9)


def test_kmeans_of_few_points(spark):
    assigned, centres = CL.assign(_vectors(spark, [[0, 0]] * 30 + [[9, 9]]), k=4, restarts=2)
    assert centres == [[0, 0], [9, 9]]
    assert sorted((r.cluster for r in assigned.collect())) == [0] * 30 + [1]
    none = _vectors(spark, [[0, 0]]).where("false")
    assert CL.kmeans_sweep(none, ks=[2], restarts=1).count() == 0 and CL.assign(none)[0].count() == 0


def test_linear_models_on_moments(spark):
    """Ridge in closed form, lasso by its optimality conditions, on rows with
    gaps and a constant column."""
    from leadlens.operators import linear as LI
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.2, 1] + [100, 0, 3, 0]
    x[:, 3] += 0.7 * x[:, 0]
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=300)
    rows = [(*map(float, r), 7.0, float(t)) for r, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 7.0, 1e6), (1.0, 1.0, 1.0, 1.0, 7.0, None)]
    cols = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*cols, "y"])).repartition(5)
    full = np.column_stack([x, np.full(300, 7.0)])
    c, t = full - full.mean(axis=0), y - y.mean()
    got = {r.feature: r.coefficient for r in LI.fit_on_moments(df, cols, "y", ridge=3.0).collect()}
    want = np.linalg.solve(c.T @ c + 3 * np.eye(5), c.T @ t)
    assert np.allclose([got[k] for k in cols], want, atol=2e-6)
    assert got["intercept"] == pytest.approx(y.mean() - full.mean(axis=0) @ want, abs=2e-6)
    got = {r.feature: r.coefficient for r in LI.fit_on_moments(df, cols, "y", lasso=0.2).collect()}
    b = np.array([got[k] for k in cols])
    pull = c.T @ (t - c @ b) / 300
    assert (b != 0).sum() in (2, 3) and b[4] == 0
    assert np.allclose(pull[b != 0], 0.2 * np.sign(b[b != 0]), atol=1e-4) and (np.abs(pull[b == 0]) <= 0.2 + 1e-4).all()
    none = LI.fit_on_moments(df.where("a is null"), cols, "y").collect()
    assert len(none) == 6 and all(r.coefficient is None for r in none)
