"""Forests grown on the sparse design rows, and their attributions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.operators import explain as EX
from leadlens.operators import forest as FO
from leadlens.operators import models as MO
from leadlens.operators import sparse as SP
from leadlens.operators import trees as T


@pytest.fixture(scope="module")
def design(spark):
    """Two numeric columns, two category columns (one with many levels), a
    constant one and missing levels."""
    rng = np.random.default_rng(8)
    n = 900
    a, b = rng.permutation(n) / 10, rng.permutation(n) - 300.0
    g, h = rng.integers(0, 200, n), rng.integers(0, 4, n)
    y = np.sin(a / 20) * 3 + (g < 9) * 4 + (h == 2) * (b > 50) * 2 + rng.normal(0, 0.5, n)
    rows = [(f"s{i}", float(a[i]), float(b[i]), None if i % 50 == 0 else f"g{g[i]:03d}", f"h{h[i]}", "one",
             "test" if i % 5 == 0 else "train", float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "sku string, a double, b double, g string, h string, c string, split string, lead_time double")
    return SP.design_matrix(df, keep=("split",))


def _train(d):
    return d.rows.where("split = 'train'")


def _predictions(model, d):
    return dict(model.transform(d.rows).select("sku", "prediction").collect())


def test_a_unit_is_grown_as_by_passes(design):
    """With every row drawn once, a unit's tree is that of ``trees``."""
    want = T.fit(_train(design), design.width, max_depth=6, min_rows=2)
    rows = T.binned(_train(design), int(want.trees[0][1].count[0]), want.thresholds, want.base).toArrow().combine_chunks()
    x, e = T._read(rows.to_batches()[0])
    got = FO.grow_unit(x, e, np.ones(len(e), dtype=np.uint8), 2, 6, 2)
    tree = want.trees[0][1]
    assert len(got.left) == len(tree.left) and np.allclose(got.value[got.walk(x)], tree.value[tree.walk(x)], atol=1e-9)


def test_upper_levels_and_units_give_the_same_forest(design, monkeypatch):
    """Whether a node is split by a pass over all rows or in its unit."""
    kw = dict(n_trees=5, max_depth=12)
    whole = FO.fit(_train(design), design.width, **kw)
    assert len(whole.top.left) == 5 and whole.units.tolist() == [0, 1, 2, 3, 4]
    want = _predictions(whole, design)
    monkeypatch.setattr(FO, "UNIT_ROWS", 60)
    monkeypatch.setattr(FO, "PASS_NODES", 3)
    parts = FO.fit(_train(design), design.width, **kw)
    assert len(parts.top.left) > 50 and len(parts.units) > 20
    got = _predictions(parts, design)
    assert got.keys() == want.keys() and len(want) == 900
    assert max(abs(got[k] - want[k]) for k in want) < 1e-8


def test_bags_are_poisson_draws_of_every_row():
    ids = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 50_000)
    a, b = FO.bag(ids, 0), FO.bag(ids, 1)
    for w in (a, b):
        assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.02 and (FO.bag(ids[::-1], 0)[::-1] == a).all()


def test_nodes_tell_the_predictions_and_attributions_sum_to_them(spark, design, monkeypatch):
    monkeypatch.setattr(MO, "FORESTS", {"Random Forest": dict(n_trees=4, max_depth=30)})
    monkeypatch.setattr(FO, "UNIT_ROWS", 200)
    model, pred = MO.fit_predict(design, "Random Forest")
    told = {r.sku: r.prediction for r in pred.collect()}
    trees = EX.tree_arrays(model.node_table(spark).toArrow())
    assert len(trees) == 4
    for r in design.rows.where("sku in ('s0', 's5', 's7', 's50', 's123')").collect():
        ends = []
        for t in trees:
            at = 0
            while t["left"][at] >= 0:
                at = t["left"][at] if r.features[int(t["feature"][at])] <= t["threshold"][at] else t["right"][at]
            ends.append(t["value"][at])
        assert told[r.sku] == pytest.approx(np.mean(ends), abs=1e-9)
    test = design.rows.where("split = 'test'")
    sums = EX.attributions(model, test, design.names, spark).groupBy("sku").agg(
        (F.sum("phi") + F.first("base_value")).alias("s")).collect()
    assert len(sums) == 180 and max(abs(r.s - told[r.sku]) for r in sums) < 1e-9


def test_rows_that_nothing_parts_end_above_the_units(spark, monkeypatch):
    """A node of many equal rows is a leaf, and none of its rows go to a task."""
    monkeypatch.setattr(FO, "UNIT_ROWS", 20)
    rows = [(f"s{i}", 1.0 if i < 300 else float(i), "x" if i < 300 else "y", float(i % 7)) for i in range(330)]
    d = SP.design_matrix(spark.createDataFrame(rows, "sku string, a double, g string, lead_time double"))
    model = FO.fit(d.rows, d.width, n_trees=3, max_depth=8)
    ends = np.setdiff1d(np.flatnonzero(model.top.left < 0), model.units)
    assert len(ends) == 3 and model.top.count[ends].min() > 200
    got = _predictions(model, d)
    assert len(got) == 330 and len({got[f"s{i}"] for i in range(300)}) == 1 and abs(got["s0"] - 3) < 0.4


def test_a_forest_row_holds_its_columns_not_the_dummies(design):
    """Before, a row of the forest's fit held a number for every level."""
    train = _train(design)
    model, _ = MO.fit_predict(design, "Random Forest")
    rows = T.binned(train, train.count(), model.thresholds, model.base, F.xxhash64("sku"))
    assert design.width > 190 and rows.agg(F.max(F.length("x"))).first()[0] == 4 * (2 + 3)
    assert model.below.where("tree < 100").select("tree").distinct().count() == 100


def test_groups_of_trees_give_the_same_forest_in_a_record_a_unit(spark, design, monkeypatch):
    """Before, all trees' drawn rows were dealt at once, and every node was a row of 69 bytes."""
    kw = dict(n_trees=5, max_depth=12)
    want = _predictions(FO.fit(_train(design), design.width, **kw), design)
    monkeypatch.setattr(FO, "UNIT_ROWS", 200)
    monkeypatch.setattr(FO, "GROUP_ROWS", 1_500)
    model = FO.fit(_train(design), design.width, **kw)
    assert model.groups == 3 and model.below.count() == len(model.units) > 10
    got = _predictions(model, design)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-8
    size = model.below.agg(F.sum(sum(F.length(c) for c in ("split", "col", "cut", "mean", "rows"))), F.sum("nodes")).first()
    assert size[0] < 11 * size[1]
