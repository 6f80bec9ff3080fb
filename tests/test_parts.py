"""Large steps work in parts: the same rows, and a part's shuffle files go before
the next one begins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.functions.ids import numbered
from leadlens.llm.common import materialise as llm_materialise
from leadlens.operators.features import encoded_fact, written_encoded_fact
from leadlens.plans import ml_catalog
from leadlens.session import materialise
from leadlens.sources.catalog import typed
from leadlens.sources.fact import base_columns, fact, fact_path, items, write_fact, written_items

from .conftest import SF_SMALL


def _rows(df):
    return sorted(map(repr, df.collect()))


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in found.apply(i).getName() for i in range(found.size()))


def test_a_fact_in_parts_has_the_same_rows(spark, tmp_path):
    write_fact(spark, SF_SMALL, f"{tmp_path}/one")
    write_fact(spark, SF_SMALL, f"{tmp_path}/many", part_rows=1_700)
    one, many = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("one", "many"))
    assert (tmp_path / "many" / "_SUCCESS").exists()
    assert one.schema == many.schema and _rows(one) == _rows(many)


def test_items_encodings_and_ids_in_parts_are_the_same(spark):
    rows = base_columns(fact(spark, SF_SMALL)).where("sku < 'SKU12'").withColumn(
        "sku", F.when(F.col("sku") != "SKU10", F.col("sku")))
    n = rows.count()
    assert _rows(written_items(rows, part_rows=n // 3)) == _rows(items(rows))
    assert _rows(written_encoded_fact(rows, part_rows=n // 3)) == _rows(encoded_fact(rows))
    assert _rows(typed(rows, part_rows=n // 5)) == _rows(typed(rows))


def test_numbers_in_parts_follow_the_order_nulls_first(spark):
    df = spark.createDataFrame([(x, k) for k, x in enumerate([None, 2.5, float("nan"), -1.0, None, 7.0, 2.5, 0.0])], "x double, k int")
    got = numbered(df, ["x", "k"], parts=3, n_rows=8)
    assert [(r.k, r.id) for r in got.orderBy("id").collect()] == [(k, i + 1) for i, k in enumerate([0, 4, 3, 7, 1, 6, 5, 2])]


def test_shuffle_files_of_a_written_table_go(spark):
    before = _shuffle_files(spark)
    t = materialise(spark.range(5_000).repartition(7, "id").groupBy((F.col("id") % 11).alias("k")).count(), "freed")
    assert _shuffle_files(spark) <= before and t.count() == 11


def test_the_first_call_makes_the_items_once(spark, tmp_path):
    d = tmp_path / "sf"
    d.mkdir()
    for t in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region"):
        (d / f"{t}.parquet").symlink_to(f"{SF_SMALL}/{t}.parquet")
    first = fact_path(spark, str(d))
    assert first == fact_path(spark, str(d))
    assert ml_catalog._items(spark, str(d)) is ml_catalog._items(spark, str(d))


def test_shuffle_files_of_an_operators_step_go(spark):
    before = _shuffle_files(spark)
    t = llm_materialise(spark.range(5_000).repartition(7, "id").groupBy((F.col("id") % 13).alias("k")).count(), "freed")
    assert _shuffle_files(spark) <= before and t.count() == 13
