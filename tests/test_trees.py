"""Trees grown on the sparse design rows against Spark's learner."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from leadlens.operators import models as MO
from leadlens.operators import sparse as SP
from leadlens.operators import trees as T


@pytest.fixture(scope="module")
def design(spark):
    """Two numeric columns of distinct values, two category columns (one with
    many levels), a constant one and missing levels."""
    rng = np.random.default_rng(4)
    n = 1500
    a, b = rng.permutation(n) / 10, rng.permutation(n) - 700.0
    g, h = rng.integers(0, 300, n), rng.integers(0, 4, n)
    y = np.sin(a / 20) * 3 + (g < 9) * 4 + (h == 2) * (b > 50) * 2 + rng.normal(0, 0.5, n)
    rows = [(f"s{i}", float(a[i]), float(b[i]), None if i % 50 == 0 else f"g{g[i]:03d}", f"h{h[i]}", "one",
             "test" if i % 5 == 0 else "train", float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "sku string, a double, b double, g string, h string, c string, split string, lead_time double")
    return SP.design_matrix(df, keep=("split",))


def _predictions(model, d):
    return dict(model.transform(d.rows).select("sku", "prediction").collect())


@pytest.mark.parametrize("kw,learner,settings", [
    (dict(max_depth=5), DecisionTreeRegressor, dict(maxDepth=5)),
    (dict(max_depth=4, min_rows=5), DecisionTreeRegressor, dict(maxDepth=4, minInstancesPerNode=5)),
    (dict(max_depth=3, rounds=13, step=0.3), GBTRegressor, dict(maxIter=13, maxDepth=3, stepSize=0.3))])
def test_as_sparks_learner(design, kw, learner, settings):
    train = design.rows.where("split = 'train'")
    mine, theirs = T.fit(train, design.width, **kw), learner(maxBins=64, labelCol="label", **settings).fit(train)
    got, want = _predictions(mine, design), _predictions(theirs, design)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-8
    # features that part a node's rows alike stand in for one another
    assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-3)


def test_shuffled_cells_give_the_same_trees(design, monkeypatch):
    train = design.rows.where("split = 'train'").repartition(5)
    kw = dict(max_depth=4, rounds=3, step=0.3)
    want = _predictions(T.fit(train, design.width, **kw), design)
    for name, value in (("DRIVER_CELLS", 0), ("CELLS", 100), ("FEW_ROWS", 200), ("REWRITE", 1)):
        monkeypatch.setattr(T, name, value)
    got = _predictions(T.fit(train, design.width, **kw), design)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-8


def test_a_training_row_holds_its_columns_not_the_dummies(design):
    """What the fits read of a row does not grow with the levels."""
    train = design.rows.where("split = 'train'")
    rows = T.binned(train, train.count(), T.find_thresholds(train, train.count(), "sku", 42), 0.0)
    assert design.width > 300 and rows.agg(F.max(F.length("x"))).first()[0] == 4 * (2 + 3)


def test_leaves_of_the_bottleneck_tree(design):
    tree = MO.bottleneck_tree(design)
    nodes = {r.id: r for r in tree.nodes(design.rows.sparkSession).collect()}
    leaves = sorted(i for i, r in nodes.items() if r.left < 0)
    for r in MO.leaf_patterns(tree, design).where("split = 'train'").collect():
        node = nodes[leaves[int(r.leaf)]]
        assert node["count"] == r.rows and node.prediction == pytest.approx(r.avg_lead_time, abs=1e-6)


def test_training_needs_labels_and_finite_features(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 2.0)], "sku string, a double, lead_time double")
    with pytest.raises(Exception, match="finite"):
        T.fit(SP.design_matrix(df).rows, 1, 2)
    with pytest.raises(ValueError, match="label"):
        T.fit(SP.design_matrix(df).rows.withColumn("label", F.lit(None).cast("double")), 1, 2)
