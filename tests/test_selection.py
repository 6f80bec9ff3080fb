"""Exact quantiles, stratified split and nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.functions.quantiles import exact_quantiles, profile, select_ranks
from leadlens.functions.sketch import Fold, merge_all, unpack
from leadlens.operators import knn
from leadlens.operators.knn import knn_regress, regression_metrics
from leadlens.operators.split import allocate_test, stratified_split


def _np_quantile(x, p):
    return float(np.quantile(np.asarray(x, dtype=float), p))


@pytest.mark.parametrize("kw", [{}, {"size": 200}, {"size": 20}, {"size": 2}])
def test_quantiles_match_numpy_with_hot_value(spark, kw):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(0, 1, 2000), np.full(1000, 0.25)])      # a third of rows on one value
    b = rng.integers(0, 5, 3000).astype(float)
    rows = [(float(x), float(y), None if i % 11 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    q = exact_quantiles(df, ["a", "b", "c"], probs, **kw)
    cvals = [r[2] for r in rows if r[2] is not None]
    for i, p in enumerate(probs):
        assert q["a"][i] == pytest.approx(_np_quantile(a, p), rel=0, abs=1e-12)
        assert q["b"][i] == pytest.approx(_np_quantile(b, p), abs=1e-12)
        assert q["c"][i] == pytest.approx(_np_quantile(cvals, p), abs=1e-12)


def test_select_ranks_reports_first_rank_of_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (2.0,), (3.0,)], "x double")
    sizes, picked = select_ranks(df, {"x": F.col("x")}, lambda k, n: [0, 2, 3, 4])
    assert sizes == {"x": 5}
    assert picked[("x", 0)] == (1.0, 0) and picked[("x", 2)] == (2.0, 1) and picked[("x", 4)] == (3.0, 4)


def test_empty_column_quantile_is_none(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_summary_bounds_hold_in_any_merge_order():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 4000), np.full(2000, 0.25), rng.integers(-3, 3, 1500).astype(float)])
    rng.shuffle(x)
    folds = []
    for part in np.array_split(x, 13):
        fold = Fold(30)
        for batch in np.array_split(part, 7):
            fold.add(batch)
        folds.append(fold.summary())
    rng.shuffle(folds)
    s = merge_all(folds, 30)
    assert s.n == len(x) and len(s.values) <= 2 * 30 + 2
    less = np.array([(x < v).sum() for v in s.values])
    upto = np.array([(x <= v).sum() for v in s.values])
    assert (s.bounds[0] <= less).all() and (less <= s.bounds[1]).all()
    assert (s.bounds[2] <= upto).all() and (upto <= s.bounds[3]).all()
    ordered = np.sort(x)
    for r in range(0, len(x), 97):
        lo, hi, before = s.bracket(r)
        assert lo <= ordered[r] <= hi
        assert before is None or (before == (x < lo).sum() and lo == ordered[r])
    # an interval holds a small share of the rows, but for a value that many rows hold
    spans = [(lo, hi) for lo, hi, _ in map(s.bracket, range(0, len(x), 97))]
    assert max(((x > lo) & (x < hi)).sum() for lo, hi in spans) < len(x) / 4
    back = unpack(s.pack())
    assert back.n == s.n and (back.values == s.values).all() and (back.bounds == s.bounds).all()


def test_moments_and_ranks_per_group_with_gaps(spark):
    rows = [(None if i % 7 == 0 else f"g{i % 3}", float(i * i % 101) if i % 5 else None, float("nan") if i % 4 else float(i))
            for i in range(600)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    stats, picked = profile(df, [F.col("x"), F.col("y")], lambda name, n: [0, n // 2, n], F.col("g"), size=4)
    for g in {r[0] for r in rows}:
        for c in (0, 1):
            v = np.sort([r[1 + c] for r in rows if r[0] == g and r[1 + c] is not None and r[1 + c] == r[1 + c]])
            s = stats[(g, c)]
            assert (s.n, s.low, s.high) == (len(v), v[0], v[-1])
            assert s.mean == pytest.approx(v.mean()) and s.m2 == pytest.approx(((v - v.mean()) ** 2).sum())
            for r in (0, len(v) // 2):
                assert picked[((g, c), r)] == (v[r], (v < v[r]).sum())
            assert ((g, c), len(v)) not in picked


def test_split_with_a_null_stratum(spark):
    rows = [(f"k{i}", None if i % 4 == 0 else "a") for i in range(80)]
    out = stratified_split(spark.createDataFrame(rows, "sku string, product_type string")).collect()
    assert {(g, sum(1 for r in out if r.product_type == g and r.split == "test")) for g in (None, "a")} == {(None, 4), ("a", 12)}


def test_allocation_largest_remainder():
    assert allocate_test({"haircare": 34, "skincare": 40, "cosmetics": 26}) == \
        {"haircare": 7, "skincare": 8, "cosmetics": 5}
    alloc = allocate_test({"a": 1, "b": 1, "c": 1})
    assert sum(alloc.values()) == 1


def test_stratified_split_is_exact_and_disjoint(spark):
    rows = [(f"k{i}", "a" if i % 3 else "b") for i in range(301)]
    df = spark.createDataFrame(rows, "sku string, product_type string")
    out = stratified_split(df).collect()
    assert len(out) == 301 and len({r.sku for r in out}) == 301
    sizes = {"a": sum(1 for _, g in rows if g == "a"), "b": sum(1 for _, g in rows if g == "b")}
    alloc = allocate_test(sizes)
    for g in sizes:
        assert sum(1 for r in out if r.product_type == g and r.split == "test") == alloc[g]
    # the test rows of a stratum are those first in hash order
    import hashlib
    for g in sizes:
        keys = sorted((hashlib.md5(f"42|{r.sku}".encode()).hexdigest(), r.sku) for r in out if r.product_type == g)
        first = {k for _, k in keys[:alloc[g]]}
        assert first == {r.sku for r in out if r.product_type == g and r.split == "test"}


@pytest.mark.parametrize("cell_rows", [4, 64, 10_000])
def test_knn_matches_brute_force(spark, cell_rows, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(3)
    n_train, n_query, d = 300, 80, 3
    tr = np.round(rng.normal(0, 1, (n_train, d)) * np.array([50.0, 1.0, 0.1]), 1)   # ties in distances
    qu = np.round(rng.normal(0, 1, (n_query, d)) * np.array([50.0, 1.0, 0.1]), 1)
    lab = rng.integers(0, 30, n_train).astype(float)
    feats = ["f0", "f1", "f2"]
    train = spark.createDataFrame([(f"t{i:04d}", float(lab[i]), *map(float, tr[i])) for i in range(n_train)],
                                  "sku string, label double, f0 double, f1 double, f2 double")
    query = spark.createDataFrame([(f"q{i:04d}", *map(float, qu[i])) for i in range(n_query)],
                                  "sku string, f0 double, f1 double, f2 double")
    got = {r.sku: r.prediction for r in knn_regress(train, query, feats, k=5).collect()}
    keys = [f"t{i:04d}" for i in range(n_train)]
    for j in range(n_query):
        d2 = ((tr - qu[j]) ** 2).sum(axis=1)
        order = sorted(range(n_train), key=lambda i: (d2[i], keys[i]))[:5]
        assert got[f"q{j:04d}"] == pytest.approx(lab[order].mean(), abs=1e-9)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    m = regression_metrics(df).first()
    assert m.r2 == 0.0 and m.mae == pytest.approx(2 / 3, abs=1e-6) and m.rmse == pytest.approx((2 / 3) ** 0.5, abs=1e-6)


def test_knn_with_hot_duplicate_vector(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 16)
    rng = np.random.default_rng(11)
    tr = np.round(rng.normal(0, 1, (300, 2)), 2)
    tr[:150] = [0.1, 0.2]                        # half the training rows are one point
    qu = np.round(rng.normal(0, 0.3, (40, 2)), 2)
    lab = rng.integers(0, 30, 300).astype(float)
    train = spark.createDataFrame([(f"t{i:04d}", float(lab[i]), *map(float, tr[i])) for i in range(300)],
                                  "sku string, label double, f0 double, f1 double")
    query = spark.createDataFrame([(f"q{i:04d}", *map(float, qu[i])) for i in range(40)],
                                  "sku string, f0 double, f1 double")
    got = {r.sku: r.prediction for r in knn_regress(train, query, ["f0", "f1"], k=5).collect()}
    keys = [f"t{i:04d}" for i in range(300)]
    for j in range(40):
        d2 = ((tr - qu[j]) ** 2).sum(axis=1)
        order = sorted(range(300), key=lambda i: (d2[i], keys[i]))[:5]
        assert got[f"q{j:04d}"] == pytest.approx(lab[order].mean(), abs=1e-9)


def test_knn_with_hot_value_in_top_coordinate(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 8)
    rng = np.random.default_rng(13)
    tr = np.round(rng.normal(0, 1, (400, 3)) * np.array([100.0, 5.0, 1.0]), 1)
    tr[:200, 0] = 12.5                           # half the rows share the dominant coordinate
    qu = np.round(rng.normal(0, 1, (50, 3)) * np.array([100.0, 5.0, 1.0]), 1)
    qu[:25, 0] = 12.5
    lab = rng.integers(0, 30, 400).astype(float)
    feats = ["f0", "f1", "f2"]
    train = spark.createDataFrame([(f"t{i:04d}", float(lab[i]), *map(float, tr[i])) for i in range(400)],
                                  "sku string, label double, f0 double, f1 double, f2 double")
    query = spark.createDataFrame([(f"q{i:04d}", *map(float, qu[i])) for i in range(50)],
                                  "sku string, f0 double, f1 double, f2 double")
    got = {r.sku: r.prediction for r in knn_regress(train, query, feats, k=5).collect()}
    keys = [f"t{i:04d}" for i in range(400)]
    for j in range(50):
        d2 = ((tr - qu[j]) ** 2).sum(axis=1)
        order = sorted(range(400), key=lambda i: (d2[i], keys[i]))[:5]
        assert got[f"q{j:04d}"] == pytest.approx(lab[order].mean(), abs=1e-9)


def test_knn_with_heavy_cell_sparse_corner_and_codes(spark, monkeypatch):
    """A crowd that one cell cannot hold, a few rows far away, queries beyond
    them, a tree that may not grow, and category columns."""
    monkeypatch.setattr(knn, "CELL_ROWS", 8)
    monkeypatch.setattr(knn, "QUERY_ROWS", 5)
    monkeypatch.setattr(knn, "MAX_CELLS", 12)
    rng = np.random.default_rng(17)
    tr = np.round(np.concatenate([rng.normal(0, 0.2, (350, 2)), [[90.0, 90.0], [95.0, 80.0], [-70.0, 99.0]]]), 2)
    qu = np.round(np.concatenate([rng.normal(0, 0.2, (40, 2)), [[99.0, 99.0], [-99.0, 99.0], [50.0, -50.0]]]), 2)
    tc, qc = rng.integers(-1, 3, (len(tr), 2)), rng.integers(-1, 3, (len(qu), 2))
    lab = rng.integers(0, 30, len(tr)).astype(float)
    schema = "sku string, label double, x array<double>, c array<int>"
    train = spark.createDataFrame([(f"t{i:04d}", float(lab[i]), tr[i].tolist(), tc[i].tolist()) for i in range(len(tr))], schema)
    query = spark.createDataFrame([(f"q{i:04d}", 0.0, qu[i].tolist(), qc[i].tolist()) for i in range(len(qu))], schema)
    got = {r.sku: r.prediction for r in knn_regress(train, query, F.col("x"), k=5, codes=F.col("c")).collect()}
    dummies = lambda c: np.concatenate([np.arange(3)[None, :] == c[:, [j]] for j in range(2)], axis=1).astype(float)
    a, b = np.concatenate([tr, dummies(tc)], axis=1), np.concatenate([qu, dummies(qc)], axis=1)
    for j in range(len(qu)):
        d2 = ((a - b[j]) ** 2).sum(axis=1)
        order = sorted(range(len(tr)), key=lambda i: (round(d2[i], 9), i))[:5]
        assert got[f"q{j:04d}"] == pytest.approx(lab[order].mean(), abs=1e-9)
    assert knn_regress(train.where("false"), query, F.col("x"), codes=F.col("c")).count() == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=60),
       st.sampled_from([{}, {"size": 2}]))
def test_quantiles_property(spark, xs, kw):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    probs = [0.0, 0.33, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs, **kw)["x"]
    for p, g in zip(probs, got):
        assert g == pytest.approx(_np_quantile(xs, p), rel=1e-12, abs=1e-9)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 500), min_size=1, max_size=8))
def test_allocation_property(sizes):
    alloc = allocate_test(sizes)
    n = sum(sizes.values())
    assert sum(alloc.values()) == math.ceil(0.2 * n)
    n_train = n - math.ceil(0.2 * n)
    for k, v in sizes.items():
        assert 0 <= alloc[k] <= v
        assert abs((v - alloc[k]) - v * n_train / n) < 1.0 + 1e-9   # train share within one row of proportional


def test_knn_visits_look_at_few_boxes_whatever_the_number_of_cells(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.random((20_000, 3))
    tree = knn.Tree()
    tree.split(0, x, 1024)
    at = tree.cell_of(x)
    cells = np.unique(at)
    low, high = (np.array([f(x[at == c], axis=0) for c in cells]) for f in (np.min, np.max))
    low[5, 1] = high[5, 1] = np.nan                      # a cell with a NaN is not reached, its neighbours are
    nodes = knn.node_boxes(tree, (cells, np.bincount(at)[cells], low, high))
    q, r2 = x[:500], np.full(500, 0.02 ** 2)
    near = (np.maximum(0, np.maximum(low - q[:, None], q[:, None] - high)) ** 2).sum(axis=2)
    want = {(int(i), int(cells[j])) for i, j in zip(*np.nonzero(near <= r2[:, None]))}
    looked, maximum = [], np.maximum
    monkeypatch.setattr(knn, "PAIRS", 100)
    monkeypatch.setattr(np, "maximum", lambda a, b: looked.append(len(b)) or maximum(a, b))
    got = [(int(i), int(c)) for rows, on in knn.reached(tree, nodes, q, r2) for i, c in zip(rows, on)]
    monkeypatch.undo()
    assert len(got) == len(set(got)) and set(got) == want and len(cells) > 900
    assert max(looked) <= 100 and sum(looked) / 2 < 60 * len(q)       # all boxes: over 900 a query
