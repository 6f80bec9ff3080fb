"""Hand-made edge frames: bins, ties, gaps, zero divisors, text, empty input."""

import math

import pytest
from pyspark.sql import functions as F

from leadlens.functions.aggs import mean, null_count
from leadlens.functions.ids import numbered
from leadlens.functions.text import strip, strip_title, title
from leadlens.operators import features as FE
from leadlens.operators import quality as Q
from leadlens.operators import reports as R
from leadlens.operators import sparse as SP
from leadlens.operators import stats as S
from leadlens.schema import DEFECT_BIN_EDGES, DEFECT_BIN_LABELS, fact_struct


def test_cut_is_right_closed_and_excludes_lowest(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0000001,), (2.0,), (3.0,), (5.0,), (10.0,), (10.5,), (None,)],
                               "x double")
    got = [r.b for r in df.select(FE.cut(F.col("x"), DEFECT_BIN_EDGES, DEFECT_BIN_LABELS).alias("b")).collect()]
    assert got == [None, "Very Low", "Low", "Low", "Medium", "High", "Very High", None, None]


def test_qcut_includes_lowest_and_is_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)], "x double")
    edges = FE.qcut_edges(df, "x")
    assert edges == [1.0, 3.0, 5.0, 7.0, 9.0]
    got = [r.b for r in df.select(FE.qcut(F.col("x"), edges, ["a", "b", "c", "d"]).alias("b")).collect()]
    assert got == ["a", "a", "a", "b", "b", "c", "c", "d", "d"]


def test_qcut_rejects_duplicate_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(2.0,)], "x double")
    with pytest.raises(ValueError):
        FE.qcut_edges(df, "x")


def test_modes_take_lowest_of_ties(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", "y"), ("a", "y"), (None, None), (None, None)],
                               "g string, h string")
    assert Q.modes(df, ["g", "h"]) == {"g": "a", "h": "x"}


def test_top_n_tiebreak_by_key(spark):
    rows = [(f"SKU{i}", 30 if i in (3, 7) else 29 if i < 9 else 1) for i in range(12)]
    df = spark.createDataFrame(rows, "sku string, lead_time int")
    items = R.recommendation_items(
        df.withColumn("location", F.lit("L")).withColumn("supplier_name", F.lit("S"))
          .withColumn("defect_rates", F.lit(1).cast("decimal(5,2)")), top_n=5)
    top = [r.details for r in items.where(F.col("insight_type").startswith("Top")).collect()]
    assert top == ["SKU3", "SKU7", "SKU0", "SKU1", "SKU2"]


def test_sparse_column_rule_is_strict(spark):
    # a: 3 of 4 missing (75 %), b: exactly half, c: none
    df = spark.createDataFrame([(None, None, 1), (None, None, 2), (None, 1.0, 3), (1, 2.0, 4)],
                               "a int, b double, c int")
    assert Q.sparse_columns(df) == ["a"]
    prof = {r.column: (r.missing_count, r.missing_pct) for r in Q.missing_profile(df).collect()}
    assert prof == {"a": (3, 75.0), "b": (2, 50.0), "c": (0, 0.0)}


def test_impute_median_interpolates_and_mode_fills(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (10, None), (None, "x"), (None, "y")],
                               "v int, s string")
    out = Q.impute(df).collect()
    assert [r.v for r in out] == [1.0, 2.0, 3.0, 10.0, 2.5, 2.5]
    assert [r.s for r in out] == ["x", "y", "y", "y", "x", "y"]


def test_zero_divisors_become_one(spark):
    df = spark.createDataFrame([(100.0, 40.0, 0, 5, 50, 0), (0.0, 10.0, 2, 8, 30, 3)],
                               "revenue_generated double, costs double, stock_levels int, order_quantities int, "
                               "production_volumes int, manufacturing_lead_time int")
    r = FE.efficiency_feature(FE.ratio_features(df)).collect()
    assert r[0].profit_margin == 0.6 and r[0].inventory_turnover_ratio == 5.0
    assert r[1].profit_margin == -10.0 and r[1].inventory_turnover_ratio == 4.0
    assert r[0].manufacturing_efficiency == 50.0 and r[1].manufacturing_efficiency == 10.0


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)], "a double, b double, c double")
    m = {(r.x, r.y): r.corr for r in S.correlation_matrix(df).collect()}
    assert m[("c", "a")] is None and m[("c", "c")] is None
    assert m[("a", "a")] == 1.0
    assert math.isclose(m[("a", "b")], 0.993399, abs_tol=1e-6)


def test_pairwise_complete_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (4.0, 4.0), (None, 100.0)], "a double, b double")
    m = {(r.x, r.y): r.corr for r in S.correlation_matrix(df).collect()}
    assert m[("a", "b")] == 1.0


def test_strip_and_title(spark):
    df = spark.createDataFrame([(" pass\t",), ("non-binary",), ("o'neil",), (None,), ("AIR  ",)], "s string")
    got = [r.t for r in df.select(strip_title("s").alias("t")).collect()]
    assert got == ["Pass", "Non-Binary", "O'Neil", None, "Air"]
    assert [r.t for r in df.select(strip("s").alias("t")).collect()][0] == "pass"
    assert df.select(title(F.lit("hello world")).alias("t")).first().t == "Hello World"


def test_empty_input_aggregates(spark):
    df = spark.createDataFrame([], fact_struct())
    nc = R.null_counts(df).collect()
    assert len(nc) == 1 and nc[0].missing_lead_time is None
    tr = R.target_range(df).first()
    assert tr.avg_lead_time is None and tr.min_lead_time is None
    assert R.overview(df).first().total_rows == 0
    assert df.agg(mean("lead_time").alias("m"), null_count("lead_time").alias("n")).first() == (None, None)


def test_volume_category_has_no_else(spark):
    df = spark.createDataFrame([(299,), (300,), (700,), (701,), (None,)], "production_volumes int")
    got = [r.c for r in df.select(R.volume_category().alias("c")).collect()]
    assert got == ["Low Volume", "Medium Volume", "Medium Volume", "High Volume", None]


def test_bottleneck_rules_first_match_wins(spark):
    df = spark.createDataFrame([(2.5, 800, 100.0, 25), (2.5, 10, 100.0, 25), (1.0, 800, 100.0, 25),
                                (1.0, 10, 100.0, 25), (1.0, 10, 50.0, 25), (2.0, 10, 100.0, 20)],
                               "defect_rates double, production_volumes int, price double, lead_time int")
    df = df.withColumn("defect_rates", F.col("defect_rates").cast("decimal(5,2)")) \
           .withColumn("price", F.col("price").cast("decimal(10,2)"))
    got = [r.c for r in df.select(R.bottleneck_category().alias("c")).collect()]
    assert got == ["High Defect & High Volume", "High Defect", "High Volume", "Premium & Delayed", "Normal", "Normal"]


def test_one_hot_drop_first_levels(spark):
    df = spark.createDataFrame([("s1", "b", "x"), ("s2", "a", None), ("s3", "c", "y"), ("s4", None, "y")], "sku string, g string, h string")
    out = SP.one_hot_drop_first(df)
    assert out.columns == ["sku", "feature", "value"]
    assert sorted(tuple(r) for r in out.collect()) == [("s1", "g_b", 1), ("s3", "g_c", 1), ("s3", "h_y", 1), ("s4", "h_y", 1)]
    assert SP.one_hot_drop_first(df.where("false")).count() == 0


def test_numbered_is_dense_and_stable(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x").alias("w"))
    for parts in (1, 7):
        got = numbered(df.repartition(parts), ["v"]).orderBy("v").collect()
        assert [(r.id, r.v) for r in got] == [(k + 1, k) for k in range(5000)]
    assert numbered(df.where("false"), ["v"]).count() == 0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "lead_time double")
    h = S.histogram(df, bins=5).collect()
    assert [r["count"] for r in h] == [2, 2, 2, 2, 3]


def test_recommendation_text_orders_by_metric(spark):
    items = spark.createDataFrame([("Locations Needing Improvement", "Delhi", 18.5),
                                   ("Locations Needing Improvement", "Kolkata", 19.4),
                                   ("High Defect Suppliers", "Supplier 5", 2.7)],
                                  "insight_type string, details string, metric double")
    got = {r.insight_type: r.details for r in R.recommendation_text(items).collect()}
    assert got == {"Locations Needing Improvement": "Kolkata,Delhi", "High Defect Suppliers": "Supplier 5"}


def test_ranked_text_of_a_hot_group_ties_and_nulls(spark):
    rows = [("hot", f"t{i:04d}", float(i % 50)) for i in range(3000)] + [(None, "b", None), (None, "a", 1.0), (None, None, 9.0), ("x", None, 1.0)]
    items = spark.createDataFrame(rows, "g string, t string, m double").repartition(4)
    out = R.ranked_text(items, "g", "t", "m", 70, sep="; ")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan          # cut before the shuffle
    got = {r.g: (r.t, r.listed, r.total) for r in out.collect()}
    best = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[2], r[1]))[:70]
    assert got == {"hot": ("; ".join(r[1] for r in best), 70, 3000), None: ("a; b", 2, 2)}
    assert R.ranked_text(items.limit(0), "g", "t", "m", 5).count() == 0


def test_dtype_counts(spark):
    df = spark.createDataFrame([], fact_struct())
    got = {r.dtype: r.columns for r in Q.dtype_counts(df).collect()}
    assert got["string"] == 9 and got["int"] == 9 and sum(got.values()) == 24


def test_dummies_have_no_level_limit(spark):
    """1,000 levels give 999 dummies at any size."""
    df = spark.createDataFrame([(f"S{k}", f"v{k:04d}", float(k)) for k in range(1000)], "sku string, g string, lead_time double")
    d = SP.design_matrix(df)
    names = [r.name for r in d.names.orderBy("feature").collect()]
    assert d.width == len(names) == 999 and names[0] == "g_v0001"


def test_target_encode_fit_on_train(spark):
    df = spark.createDataFrame([("a", "train", 1.0), ("a", "train", 3.0), ("a", "test", 100.0), ("b", "test", 5.0)],
                               "g string, split string, lead_time double")
    got = {(r.g, r.split): r.g_lead_time_mean for r in FE.target_encode(df, ["g"], fit_on="train").collect()}
    assert got == {("a", "train"): 2.0, ("a", "test"): 2.0, ("b", "test"): None}


def test_insight_ids_in_profile_order(spark):
    from leadlens.operators.insights import insight_rules
    corr = spark.createDataFrame([("defect_rates", 0.9), ("price", 0.0)], "feature string, corr double")
    imp = spark.createDataFrame([("defect_rates", 0.5)], "feature string, importance double")
    profile = spark.createDataFrame([(2, 10.0, 1e6), (10, 30.0, 1e6), (1, 20.0, 1e6)],
                                    "cluster int, avg_lead_time double, avg_production_volume double")
    text = " ".join(str(tuple(r)) for r in insight_rules(corr, imp, profile).collect())
    assert "Clusters 10, 1, 2 show" in text


@pytest.mark.parametrize("defects, importance, price, strict, fired", [
    (0.26, 0.0, 0.0, False, ["Quality Control"]), (0.25, 0.2, 0.15, False, []), (0.0, 0.21, 0.0, False, ["Quality Control"]),
    (0.0, 0.0, 0.16, False, ["Pricing & SKU Management"]), (0.9, 0.0, 0.9, True, []), (0.9, 0.3, 0.9, True, ["Quality Control"]),
    (None, None, None, False, [])])
def test_quality_and_pricing_rules(spark, defects, importance, price, strict, fired):
    from leadlens.operators.insights import insight_rules
    corr = spark.createDataFrame([("defect_rates", defects), ("price", price)], "feature string, corr double")
    imp = spark.createDataFrame([("defect_rates", importance)], "feature string, importance double")
    none = spark.createDataFrame([], "cluster int, avg_lead_time double, avg_production_volume double")
    got = insight_rules(corr, imp, none, strict_reference=strict).collect()
    assert [r.category for r in got] == fired
    seen = 0.0 if strict else defects
    assert all(r.evidence == f"Correlation: {seen:.3f}, Feature Importance: High" for r in got if r.category == "Quality Control")


def test_nearest_centre_takes_the_first_of_ties(spark):
    from leadlens.operators.cluster import nearest_centre
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 5.0), ("c", 3.0, 9.0)], "sku string, x double, y double")
    got = nearest_centre(df, [{"x": 1.0}, {"x": 3.0}]).collect()
    assert [(r.sku, r.cluster) for r in got] == [("a", 0), ("b", 0), ("c", 1)]
