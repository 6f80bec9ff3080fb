"""Lead-time reports over the fact relation (the SQL script's sections 2-19).

Grouped reports are one aggregation each: a partial (map-side) aggregate,
one shuffle of the partial rows by the group key, a final aggregate and a
sort, so the shuffle carries at most (#map tasks x #groups) rows whatever
the data size and a hot key costs nothing extra.  Row lists are a filter
pushed into the scan plus a range-partitioned sort; the summary's top-n
is a distributed top-k.  Thresholds are parameters; the defaults are the
values the reference uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggs import mean, moments_corr, null_count, std_pop


def overview(fact: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count and distinct counts of sku, product_type, location, supplier."""
    cd = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.countDistinct(c))
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        cd("sku").alias("unique_skus"),
        cd("product_type").alias("unique_product_types"),
        cd("location").alias("unique_locations"),
        cd("supplier_name").alias("unique_suppliers"),
    )


def product_type_brief(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product_type")
            .agg(F.count(F.lit(1)).alias("count"), mean("lead_time").alias("avg_lead_time"),
                 std_pop("lead_time").alias("std_lead_time"))
            .orderBy(F.desc("avg_lead_time")))


def null_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(null_count("lead_time").alias("missing_lead_time"),
                    null_count("defect_rates").alias("missing_defect_rates"),
                    null_count("production_volumes").alias("missing_prod_vol"))


def target_range(fact: DataFrame, target: str = "lead_time") -> DataFrame:
    return fact.agg(F.min(target).alias("min_lead_time"), F.max(target).alias("max_lead_time"),
                    mean(target).alias("avg_lead_time"), std_pop(target).alias("std_lead_time"))


def lead_time_bins(fact: DataFrame, width: int = 5) -> DataFrame:
    """Equal-step histogram: FLOOR(lead_time / width) * width."""
    b = (F.floor(F.col("lead_time") / F.lit(float(width))) * width).cast("bigint")
    return (fact.groupBy(b.alias("lead_time_bin")).agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy("lead_time_bin"))


def correlation_moments(fact: DataFrame) -> DataFrame:
    """Pearson r of lead_time with defect rate, production volume and price,
    from exact decimal moments (one pass, three pairs)."""
    lt = F.col("lead_time").cast("decimal(18,0)")
    return fact.agg(
        moments_corr(lt, F.col("defect_rates")).alias("corr_defect_rates"),
        moments_corr(lt, F.col("production_volumes").cast("decimal(18,0)")).alias("corr_production_volumes"),
        moments_corr(lt, F.col("price")).alias("corr_price"),
    )


def product_type_stats(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product_type")
            .agg(F.count(F.lit(1)).alias("record_count"), mean("lead_time").alias("avg_lead_time"),
                 F.min("lead_time").alias("min_lead_time"), F.max("lead_time").alias("max_lead_time"),
                 std_pop("lead_time").alias("std_lead_time"))
            .orderBy(F.desc("avg_lead_time")))


def _count_mean(fact: DataFrame, key: str, ascending: bool) -> DataFrame:
    out = fact.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"), mean("lead_time").alias("avg_lead_time"))
    return out.orderBy(F.asc("avg_lead_time") if ascending else F.desc("avg_lead_time"))


def by_location(fact: DataFrame) -> DataFrame:
    return _count_mean(fact, "location", ascending=False)


def by_mode(fact: DataFrame) -> DataFrame:
    return _count_mean(fact, "transportation_modes", ascending=True)


def by_supplier(fact: DataFrame, min_orders: int = 5) -> DataFrame:
    """Supplier scorecard with HAVING COUNT(*) > min_orders."""
    return (fact.groupBy("supplier_name")
            .agg(F.count(F.lit(1)).alias("total_orders"), mean("lead_time").alias("avg_lead_time"),
                 mean("defect_rates").alias("avg_defect_rate"),
                 mean("production_volumes").alias("avg_production_volume"))
            .where(F.col("total_orders") > min_orders)
            .orderBy(F.desc("avg_lead_time")))


def by_mode_route(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("transportation_modes", "routes")
            .agg(F.count(F.lit(1)).alias("shipments"), mean("lead_time").alias("avg_lead_time"),
                 mean("shipping_costs").alias("avg_shipping_cost"))
            .orderBy("avg_lead_time"))


def by_demographics(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("customer_demographics")
            .agg(F.count(F.lit(1)).alias("order_count"), mean("lead_time").alias("avg_lead_time"),
                 mean("order_quantities").alias("avg_order_quantity"))
            .orderBy(F.desc("avg_lead_time")))


def volume_category(col="production_volumes", low: int = 300, high: int = 700):
    """Searched CASE without ELSE: values outside every branch are NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c < low, "Low Volume").when(c.between(low, high), "Medium Volume")
            .when(c > high, "High Volume"))


def volume_band(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(volume_category().alias("volume_category"))
            .agg(F.count(F.lit(1)).alias("record_count"), mean("lead_time").alias("avg_lead_time"),
                 mean("defect_rates").alias("avg_defect_rate"))
            .orderBy(F.desc("avg_lead_time")))


def product_by_location(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product_type", "location")
            .agg(F.count(F.lit(1)).alias("record_count"), mean("lead_time").alias("avg_lead_time"),
                 mean("defect_rates").alias("avg_defect_rate"))
            .orderBy(F.asc("product_type"), F.desc("avg_lead_time")))


def monthly_snapshot(fact: DataFrame) -> DataFrame:
    """Per month and product type (the script's commented-out section 18)."""
    return (fact.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"), "product_type")
            .agg(F.count(F.lit(1)).alias("total_orders"), mean("lead_time").alias("avg_lead_time"),
                 mean("defect_rates").alias("avg_defect_rate"))
            .orderBy(F.desc("month"), F.desc("avg_lead_time")))


def high_lead_time(fact: DataFrame, threshold: int = 20) -> DataFrame:
    """Rows with lead_time > threshold; the filter reaches the parquet scan."""
    return (fact.where(F.col("lead_time") > threshold)
            .select("sku", "product_type", "lead_time", F.col("defect_rates").cast("double").alias("defect_rates"),
                    "production_volumes", F.col("price").cast("double").alias("price"))
            .orderBy(F.desc("lead_time")))


def high_defect(fact: DataFrame, threshold: str = "2.0") -> DataFrame:
    """Rows with defect_rates > threshold, compared in the column's decimal type."""
    return (fact.where(F.col("defect_rates") > F.lit(threshold).cast("decimal(5,2)"))
            .select("sku", "product_type", F.col("defect_rates").cast("double").alias("defect_rates"),
                    "lead_time", "inspection_results")
            .orderBy(F.desc("defect_rates")))


def bottleneck_category(defect: str = "2.0", volume: int = 700, premium_price: str = "60",
                        delayed: int = 20):
    """First matching rule wins; ELSE 'Normal'."""
    d = F.col("defect_rates") > F.lit(defect).cast("decimal(5,2)")
    v = F.col("production_volumes") > volume
    p = (F.col("price") > F.lit(premium_price).cast("decimal(10,2)")) & (F.col("lead_time") > delayed)
    return (F.when(d & v, "High Defect & High Volume").when(d, "High Defect").when(v, "High Volume")
            .when(p, "Premium & Delayed").otherwise("Normal"))


def bottleneck_class(fact: DataFrame, premium_price: str = "60", **kw) -> DataFrame:
    return (fact.select("sku", "product_type", "location", "lead_time",
                        F.col("defect_rates").cast("double").alias("defect_rates"), "production_volumes",
                        bottleneck_category(premium_price=premium_price, **kw).alias("bottleneck_category"))
            .orderBy(F.desc("lead_time")))


def recommendation_items(fact: DataFrame, top_n: int = 5, location_avg: float = 18.0,
                         supplier_defect: float = 2.5) -> DataFrame:
    """The recommendation summary in long form: one row per listed item;
    ``metric`` (descending) is the GROUP_CONCAT order inside a section.

    Section 1 is a distributed top-n (TakeOrderedAndProject: per-partition
    top-n, then one merge of n x partitions rows).  Sections 2 and 3 are
    grouped means filtered by HAVING.  No list is concatenated into one
    string here; ``recommendation_text`` does that for the first of them.
    """
    top = (fact.select("sku", "lead_time")
           .orderBy(F.desc("lead_time"), F.asc("sku")).limit(top_n)
           .select(F.lit("Top 5 Longest Lead Time SKUs").alias("insight_type"),
                   F.col("sku").alias("details"), F.col("lead_time").cast("double").alias("metric")))
    loc = (fact.groupBy("location").agg(mean("lead_time").alias("metric"))
           .where(F.col("metric") > location_avg)
           .select(F.lit("Locations Needing Improvement").alias("insight_type"),
                   F.col("location").alias("details"), "metric"))
    sup = (fact.groupBy("supplier_name").agg(mean("defect_rates").alias("metric"))
           .where(F.col("metric") > supplier_defect)
           .select(F.lit("High Defect Suppliers").alias("insight_type"),
                   F.col("supplier_name").alias("details"), "metric"))
    # one global sort; the section order is the script's UNION ALL order
    section = (F.when(F.col("insight_type").startswith("Top"), 1)
               .when(F.col("insight_type").startswith("Loc"), 2).otherwise(3))
    return (top.unionByName(loc).unionByName(sup)
            .select("insight_type", "details", "metric")
            .orderBy(section, F.desc("metric"), F.asc("details")))


def ranked_text(items: DataFrame, group: str, text: str, metric: str, limit: int, sep: str = ",") -> DataFrame:
    """Per group the texts in rank order (metric descending, then text) as one
    string of at most ``limit`` texts: group, text, ``listed`` of ``total``.

    The rank filter is cut in the map stage (a group limit below the shuffle),
    so a group holding a third of the rows sends ``limit`` rows per task, and no
    string is longer than ``limit`` texts.  Null texts are neither listed nor
    counted; a null group is a group; a null metric comes last."""
    there = items.where(F.col(text).isNotNull())
    order = (F.desc_nulls_last(metric), F.asc(text))
    first = (there.select(group, text, metric, F.row_number().over(Window.partitionBy(group).orderBy(*order)).alias("_rank"))
             .where(F.col("_rank") <= limit))
    lists = first.groupBy(F.col(group).alias("_group")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", F.col(text).alias("_text")))),
                                 lambda x: x["_text"]), sep).alias(text),
        F.count(F.lit(1)).alias("listed"))
    totals = there.groupBy(group).agg(F.count(F.lit(1)).alias("total"))
    return (totals.join(lists, F.col(group).eqNullSafe(F.col("_group")))
            .select(group, text, "listed", "total"))


def recommendation_text(items: DataFrame, limit: int = 1_000) -> DataFrame:
    """Each section of the summary as one ``details`` string in rank order
    (GROUP_CONCAT), with the first ``limit`` items and the count of all."""
    return ranked_text(items, "insight_type", "details", "metric", limit)
