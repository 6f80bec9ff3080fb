"""Sources, sinks, catalog DDL, views and the streaming snapshot."""

import os

import pytest
from pyspark.sql import functions as F

from leadlens.plans import catalog
from leadlens.sources import catalog as CT
from leadlens.sources.csv import read_supply_chain_csv
from leadlens.sources.fact import base_columns, fact

from .conftest import SF_SMALL


def test_csv_reader_handles_missing_tokens_and_names(spark, tmp_path):
    from leadlens.schema import CSV_HEADERS
    header = ",".join(CSV_HEADERS)
    row = ["haircare", "SKU0", "NA", "55", "802", "8661.99", "Non-binary", "58", "7", "96", "4", "Carrier B",
           "2.95", "Supplier 3", "Mumbai", "29", "215", "29", "46.27", "Pending", "0.22", "Road", "Route B",
           "187.75"]
    p = tmp_path / "d.csv"
    p.write_text(header + "\n" + ",".join(row) + "\n")
    df = read_supply_chain_csv(spark, str(p))
    r = df.first()
    assert df.columns[0] == "product_type" and "number_of_products_sold" in df.columns
    assert r.price is None and r.availability == 55 and r.defect_rates == 0.22 and r.lead_time == 29


def test_save_table_and_views(spark, tmp_path):
    f = base_columns(fact(spark, SF_SMALL))
    name = CT.save_supply_chain(spark, f, database="leadlens_test", path=str(tmp_path / "t"))
    t = spark.table(name)
    assert t.count() == f.count() and t.columns[0] == "id"
    assert dict(t.dtypes)["price"] == "decimal(10,2)"
    assert t.select(F.countDistinct("id")).first()[0] == f.count()
    CT.register_views(f)
    by_supplier = __import__("leadlens.operators.reports", fromlist=["x"]).by_supplier
    assert (sorted(map(tuple, by_supplier(spark.table("supply_chain")).collect()))
            == sorted(map(tuple, by_supplier(f).collect())))
    assert spark.table("ml_ready_data").count() == f.count()
    assert spark.table("clustering_features").columns == ["sku", "defect_rate_z", "production_volume_z",
                                                          "price_z", "shipping_cost_z", "lead_time"]


def test_stream_snapshot_equals_batch(spark):
    q = catalog.all_queries()
    s = {tuple(r) for r in q["monthly_snapshot_stream"](spark, SF_SMALL).collect()}
    b = {tuple(r) for r in q["monthly_snapshot"](spark, SF_SMALL).collect()}
    assert s == b and len(s) > 0


def _copy_tables(to):
    import shutil
    for name in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", to / f"{name}.parquet")


def test_fact_follows_changed_source_files_under_a_uri(spark, tmp_path):
    _copy_tables(tmp_path)
    uri = f"file://{tmp_path}"
    n = fact(spark, uri).count()
    import pyarrow.parquet as pq
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 1000), tmp_path / "lineitem.parquet")
    assert n > 1000 and fact(spark, uri).count() == 1000


def test_fact_needs_a_committed_folder(spark, tmp_path):

    from leadlens.sources.fact import fact_path
    _copy_tables(tmp_path)
    path = fact_path(spark, str(tmp_path)).removeprefix("file:")
    n = spark.read.parquet(path).count()
    os.remove(f"{path}/_SUCCESS")
    again = fact_path(spark, str(tmp_path)).removeprefix("file:")
    assert again != path and spark.read.parquet(again).count() == n


def test_csv_columns_by_header_name(spark, tmp_path):
    from leadlens.schema import CSV_HEADERS
    row = {h: "1" for h in CSV_HEADERS} | {"Lead time": "29", "Lead times": "7"}
    turned = CSV_HEADERS[::-1]
    p = tmp_path / "turned.csv"
    p.write_text(",".join(turned) + "\n" + ",".join(row[h] for h in turned) + "\n")
    r = read_supply_chain_csv(spark, str(p)).first()
    assert r.lead_time == 29 and r.lead_times == 7
    q = tmp_path / "short.csv"
    q.write_text(",".join(turned[1:]) + "\n" + ",".join(row[h] for h in turned[1:]) + "\n")
    with pytest.raises(ValueError):
        read_supply_chain_csv(spark, str(q))


def test_stream_readers_see_the_last_complete_epoch(spark, tmp_path):
    from leadlens.streaming.monthly import snapshot_table
    row = [("2024-01", "a", 2, 20, 2, 1.0, 2)]
    schema = "month string, product_type string, total_orders long, sum_lead_time long, n_lead_time long, sum_defect_rates double, n_defect_rates long"
    spark.createDataFrame(row, schema).write.parquet(f"{tmp_path}/epoch=9")
    # a later batch that stopped while it was written
    spark.createDataFrame(row * 2, schema).write.parquet(f"{tmp_path}/epoch=10")
    os.remove(f"{tmp_path}/epoch=10/_SUCCESS")
    assert [r.avg_lead_time for r in snapshot_table(spark, str(tmp_path)).collect()] == [10.0]
    assert spark.read.parquet(f"{tmp_path}/epoch=10").count() == 2


def test_surrogate_ids_do_not_depend_on_the_partitions(spark):
    from leadlens.sources.catalog import typed
    base = base_columns(fact(spark, SF_SMALL)).limit(500).checkpoint()
    one, many = [sorted(tuple(r) for r in typed(base.repartition(n)).collect()) for n in (1, 9)]
    assert one == many and [r[0] for r in one] == list(range(1, len(one) + 1))
