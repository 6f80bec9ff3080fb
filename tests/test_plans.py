"""Plan properties: pushdown, pruning, partial aggregation, no cartesian joins."""

import pytest

import __spark_entry__ as E
from leadlens.plans.catalog import eda_queries, feature_queries, report_queries

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_the_scan(spark):
    p = _plan(E.queries()["high_lead_time"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(lead_time), GreaterThan(lead_time,20)]" in p
    assert "ReadSchema: struct<product_type:string,sku:string,price:decimal(10,2),lead_time:int," in p


def test_grouped_report_is_partial_then_final(spark):
    p = _plan(E.queries()["by_supplier"](spark, SF_SMALL))
    assert "partial_count" in p and "hashpartitioning(supplier_name" in p
    assert "ReadSchema: struct<supplier_name:string,lead_time:int,production_volumes:int,defect_rates:decimal(5,2)>" in p


@pytest.mark.parametrize("name", sorted({**report_queries(), **eda_queries(), **feature_queries()}))
def test_no_cartesian_or_nested_loop_join(spark, name):
    q = {**report_queries(), **eda_queries(), **feature_queries()}[name]
    p = _plan(q(spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_correlations_scan_the_rows_once(spark):
    from leadlens.functions.moments import moment_parts
    from leadlens.operators.quality import numeric_columns
    from leadlens.operators.stats import correlation_matrix
    from leadlens.sources.fact import base_columns, fact, fact_path
    base = base_columns(fact(spark, SF_SMALL))
    assert _plan(moment_parts(base, numeric_columns(base))).count("FileScan parquet") == 1
    assert fact_path(spark, SF_SMALL).split("/")[-1] not in _plan(correlation_matrix(base))


@pytest.mark.parametrize("name", ["describe_numeric", "box_summary", "quartile_bins"])
def test_quantiles_scan_the_rows_twice_at_most(spark, monkeypatch, name):
    from leadlens.functions import quantiles
    scans, fold = [], quantiles._fold

    def counted(*args):
        parts = fold(*args)
        scans.append(_plan(parts).count("FileScan parquet"))
        return parts
    monkeypatch.setattr(quantiles, "_fold", counted)
    E.queries()[name](spark, SF_SMALL).collect()
    assert 1 <= len(scans) <= 2 and set(scans) == {1}
