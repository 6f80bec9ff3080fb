"""The supply-chain fact relation, derived from the driver's star schema.

One row per ``lineitem``; columns follow the 24-column base table plus
``order_date`` (for the monthly snapshot) and a stable ``row_id``.

At scale the relation is built once and written as a parquet table in the
shared checkpoint folder (``materialized_fact``); reports then scan that
table with column pruning and pushed filters and need no joins.  Join
strategies are left to Catalyst/AQE: nation and region are size-checked
broadcasts by Spark's own thresholds, the large dimensions sort-merge.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialise_parts, shuffles_freed
from .tables import read_table, table_path

FACT_VERSION = "v1"
HEAVY_ROWS = 1_000_000       # of a SKU, beyond which its rows are not sent to one task
HEAVY_BUCKETS = 1 << 16      # of SKUs, counted first
PART_ROWS = 1_500_000        # lines that are shuffled at a time, as long as
MOST_PARTS = 4               # there are no more parts than this


def lead_time_expr(ship: Column, order: Column) -> Column:
    """Ship-minus-order days folded into 1..30 like the CSV's lead_time."""
    return (F.pmod(F.datediff(ship, order), F.lit(30)) + 1).cast("int")


def _code(col: Column, pairs: list[tuple[str, str]], other: str) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(other)


def parts_of(rows: int, part_rows: int = PART_ROWS, most: int = MOST_PARTS) -> int:
    """In how many parts so many rows are shuffled: what lies on the disk at a
    time is a part's shuffle files, while every part scans the input anew."""
    return max(1, min(most, -(-rows // part_rows)))


def in_part(key: str, part: int, parts: int) -> Column:
    """Whether a row belongs to a part, told by its key's hash."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part if parts > 1 else F.lit(True)


def build_fact(spark: SparkSession, sf_dir: str, part: int = 0, parts: int = 1) -> DataFrame:
    """Lazy fact relation: lineitem joined to orders, customer, part and
    supplier -> nation -> region (all inner joins); of ``parts`` of the orders
    the given one."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").where(in_part("l_orderkey", part, parts))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority").where(
            in_part("o_orderkey", part, parts))
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # lines last meet the large dimensions: orders take their customer first (a
    # quarter of the lines' rows), and supplier, nation and region are joined one
    # by one, since Spark sizes a join of two tables by their product and would
    # shuffle the lines for it
    oc = od.join(cu, od.o_custkey == cu.c_custkey).drop("o_custkey", "c_custkey")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
           .join(su, li.l_suppkey == su.s_suppkey)
           .join(na, su.s_nationkey == na.n_nationkey)
           .join(rg, na.n_regionkey == rg.r_regionkey)
           .join(pt, li.l_partkey == pt.p_partkey))

    qty = F.col("l_quantity").cast("int")
    return j.select(
        F.col("p_type").alias("product_type"),
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_size").alias("availability"),
        (qty + F.col("l_linenumber")).alias("number_of_products_sold"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue_generated"),
        F.col("c_mktsegment").alias("customer_demographics"),
        (F.col("l_linenumber") - 1).alias("stock_levels"),
        (F.col("l_linenumber") * 4).alias("lead_times"),
        qty.alias("order_quantities"),
        F.col("l_linenumber").alias("shipping_times"),
        F.col("l_linestatus").alias("shipping_carriers"),
        F.round(F.col("l_tax") * 100).cast("decimal(10,2)").alias("shipping_costs"),
        F.col("s_name").alias("supplier_name"),
        F.col("r_name").alias("location"),
        lead_time_expr(F.col("l_shipdate"), F.col("o_orderdate")).alias("lead_time"),
        (F.col("p_size") * 20).alias("production_volumes"),
        (F.col("l_orderkey") % 31).cast("int").alias("manufacturing_lead_time"),
        F.abs(F.col("s_acctbal")).cast("decimal(12,2)").alias("manufacturing_costs"),
        _code(F.col("l_returnflag"), [("A", "Pass"), ("R", "Fail")], "Pending").alias("inspection_results"),
        (F.round(F.col("l_discount") * 100) * 0.5).cast("decimal(5,2)").alias("defect_rates"),
        _code(F.col("o_orderpriority"), [("1-URGENT", "Air"), ("2-HIGH", "Road"), ("3-MEDIUM", "Sea"),
                                         ("4-NOT SPECIFIED", "Rail")], "Other").alias("transportation_modes"),
        F.col("o_orderstatus").alias("routes"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("costs"),
        F.col("o_orderdate").alias("order_date"),
        F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                   "l_quantity", "l_shipdate").alias("row_id"),
    )


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files at ``path``, in any
    file system that Hadoop reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def source_signature(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the path, length and modification time of every source file."""
    h = hashlib.sha1(FACT_VERSION.encode())
    for name in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region"):
        h.update(repr(_files(spark, table_path(sf_dir, name))).encode())
    return h.hexdigest()[:16]


def completed(spark: SparkSession, prefix: str, write) -> str:
    """A folder ``prefix``-* that a committed job has finished (``_SUCCESS``),
    or else a fresh one that ``write(folder)`` fills.  No folder is ever
    written twice, so two writers cannot disturb each other or a reader."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{prefix}-*/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(x.getPath().getParent().toString() for x in (fs.globStatus(pattern) or []))
    if done:
        return done[0]
    # named as the listing names it, so that what is kept by the name is found again
    folder = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(f"{prefix}-{uuid.uuid4().hex}")).toString()
    write(folder)
    return folder


def fact_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written fact table, built if there is none for the
    present source files.  A lost executor re-reads its files instead of
    re-running the joins."""
    prefix = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fact_{source_signature(spark, sf_dir)}"
    return completed(spark, prefix, lambda to: write_fact(spark, sf_dir, to))


def write_fact(spark: SparkSession, sf_dir: str, to: str, part_rows: int = PART_ROWS) -> None:
    """Writes the fact relation part by part; the last one marks the folder
    as complete."""
    parts = parts_of(read_table(spark, sf_dir, "lineitem").count(), part_rows)
    with shuffles_freed(spark):
        for k in range(parts):
            # bounded files whatever the shuffle partition sizes are
            (build_fact(spark, sf_dir, k, parts).write.mode("append").option("maxRecordsPerFile", 20_000_000)
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(k == parts - 1).lower()).parquet(to))


def materialized_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan of the written fact table."""
    return spark.read.parquet(fact_path(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    return materialized_fact(spark, sf_dir) if materialize else build_fact(spark, sf_dir)



def base_columns(fact_df: DataFrame) -> DataFrame:
    """The 24 columns of the reference's base table, in table order."""
    from ..schema import FACT_COLUMNS
    return fact_df.select(*[n for n, _ in FACT_COLUMNS])


def item_parts(fact_df: DataFrame, heavy_rows: int = HEAVY_ROWS, part_rows: int | None = None) -> list[DataFrame]:
    """One row per SKU, the population of the model and clustering stages
    (each row of the reference's table is one SKU), in parts of the SKUs.

    Numeric columns are SKU means (double), category columns the SKU's most
    frequent value (lowest among ties).  A SKU has some rows only, spread over
    all files, so partial aggregates are wider than the rows and sorted out of
    memory by the task: the rows themselves are sent to their SKU's task.  A SKU
    of more than ``heavy_rows`` rows (found by a count of hashed SKUs, then of
    those in full buckets) would be too much for a task; those few are aggregated
    with partial rows per map task.
    """
    from ..functions.aggs import mean
    from ..schema import FACT_COLUMNS
    aggs = []
    for name, t in FACT_COLUMNS:
        if name == "sku":
            continue
        if name == "product_type":
            aggs.append(F.min(name).alias(name))
        elif t == "string":
            aggs.append(F.mode(name, True).alias(name))
        else:
            aggs.append(mean(name).alias(name))
    names = [n for n, _ in FACT_COLUMNS]
    rows = fact_df.select(*names)
    bucket = F.pmod(F.xxhash64("sku"), F.lit(HEAVY_BUCKETS))
    counted = rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(F.sum("n").alias("n"), F.collect_set(F.when(F.col("n") > heavy_rows, F.col("b"))).alias("b")).first()
    heavy = rows.where(bucket.isin(found.b)).groupBy("sku").count().where(
        F.col("count") > heavy_rows).select("sku").collect() if found.b else []
    parts = 1 if part_rows is None else parts_of(found.n or 0, part_rows)
    light, out = rows, []
    if heavy:
        is_heavy = F.when(F.col("sku").isNull(), any(r.sku is None for r in heavy)).otherwise(
            F.col("sku").isin([r.sku for r in heavy if r.sku is not None]))
        light = rows.where(~is_heavy)
        out.append(rows.where(is_heavy).groupBy("sku").agg(*aggs).select(*names))
    return [light.where(in_part("sku", k, parts)).repartition("sku").groupBy("sku").agg(*aggs).select(*names)
            for k in range(parts)] + out


def items(fact_df: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The items (see ``item_parts``) as one lazy relation."""
    return reduce(DataFrame.unionByName, item_parts(fact_df, heavy_rows))


def written_items(fact_df: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The items, written part by part."""
    return materialise_parts(fact_df.sparkSession, item_parts(fact_df, part_rows=part_rows), "items")
