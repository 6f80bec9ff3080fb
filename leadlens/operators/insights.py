"""Rule-based recommendations derived from the analysis tables.

Each rule is evaluated on small derived tables (target correlations, tree
importances, cluster profile); the result is a table of fired insights.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: insight texts ------------------------------------------
QUALITY = ("Quality Control",
           "High defect rates are strongly correlated with longer lead times",
           ["Implement real-time quality monitoring systems",
            "Establish stricter supplier quality agreements",
            "Introduce automated inspection at key production stages",
            "Create a defect tracking dashboard with root cause analysis"])
PRODUCTION = ("Production Planning",
              "High production volumes create bottlenecks and increase lead times",
              ["Implement staggered production scheduling",
               "Use load balancing across multiple production lines",
               "Introduce dynamic capacity planning tools",
               "Consider batch processing for high-volume SKUs"])
# The source text of this rule's list ends mid-sentence after its first item.
PRICING = ("Pricing & SKU Management",
           "Premium-priced SKUs experience longer lead times",
           ["Analyze supplier capacity for premium products"])

QUALITY_CORR, QUALITY_IMPORTANCE, VOLUME, PRICE_CORR = 0.25, 0.2, 700, 0.15


def _row(spark_df: DataFrame, text: tuple, evidence, fire) -> DataFrame:
    cat, problem, recs = text
    return spark_df.where(fire).select(
        F.lit(cat).alias("category"), F.lit(problem).alias("problem"), evidence.alias("evidence"),
        F.array(*[F.lit(r) for r in recs]).alias("recommendations"))


def insight_rules(target_corr: DataFrame, importance: DataFrame, profile: DataFrame,
                  strict_reference: bool = False) -> DataFrame:
    """Fired insights.  ``target_corr`` is (feature, corr) against lead time,
    ``importance`` (feature, importance), ``profile`` the cluster profile.

    With ``strict_reference`` the correlations read as 0, reproducing the
    reference, whose type check never finds them."""
    def corr_of(name):
        c = target_corr.where(F.col("feature") == name).agg(F.first("corr").alias("c"))
        return c.select(F.lit(0.0).alias("c")) if strict_reference else c.select(F.coalesce("c", F.lit(0.0)).alias("c"))

    dc = corr_of("defect_rates")
    imp = importance.where(F.col("feature") == "defect_rates").agg(F.max("importance").alias("imp")).first().imp
    q = dc.withColumn("imp", F.lit(imp).cast("double"))
    quality = _row(q, QUALITY, F.format_string("Correlation: %.3f, Feature Importance: High", F.col("c")),
                   (F.col("c") > QUALITY_CORR) | (F.coalesce(F.col("imp"), F.lit(0.0)) > QUALITY_IMPORTANCE))

    hv = (profile.where(F.col("avg_production_volume") > VOLUME)
          .agg(F.count(F.lit(1)).alias("n"),
               F.array_join(F.transform(   # in the profile's order
                   F.array_sort(F.collect_list(F.struct((-F.col("avg_lead_time")).alias("o"), F.col("cluster")))),
                   lambda x: x["cluster"].cast("string")), ", ").alias("ids")))
    production = _row(hv, PRODUCTION, F.format_string("Clusters %s show high volumes with long lead times",
                                                      F.col("ids")), F.col("n") > 0)

    pc = corr_of("price")
    pricing = _row(pc, PRICING, F.format_string("Price-Lead Time Correlation: %.3f", F.col("c")),
                   F.col("c") > PRICE_CORR)
    return reduce(DataFrame.unionByName, [quality, production, pricing])


def decision_patterns(fact: DataFrame) -> DataFrame:
    """The three literal tree-derived conditions, with the row count and
    mean lead time each one actually selects."""
    # fixed values: conditions, interpretations and recommendations as stated
    pats = [
        ("defect_rates > 2.1 AND price > 62.97",
         (F.col("defect_rates") > 2.1) & (F.col("price") > 62.97),
         "High defect rates combined with premium pricing cause severe delays",
         "Improve quality control for premium SKUs"),
        ("defect_rates <= 0.4 AND price <= 29.73",
         (F.col("defect_rates") <= 0.4) & (F.col("price") <= 29.73),
         "Low-cost, high-quality items are processed quickly",
         "Replicate this process for other products"),
        ("production_volumes > 700",
         F.col("production_volumes") > 700,
         "High production volumes create bottlenecks",
         "Implement batch processing or increase capacity"),
    ]
    aggs = []
    for i, (_, cond, _, _) in enumerate(pats):
        aggs += [F.count_if(cond).alias(f"n{i}"),
                 F.try_divide(F.sum(F.when(cond, F.col("lead_time"))).cast("double"),
                              F.count_if(cond).cast("double")).alias(f"m{i}")]
    row = fact.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("condition"), F.col(f"n{i}").cast("bigint").alias("rows"),
                      F.col(f"m{i}").alias("avg_lead_time"), F.lit(t).alias("interpretation"),
                      F.lit(r).alias("recommendation"))
             for i, (c, _, t, r) in enumerate(pats)]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")
