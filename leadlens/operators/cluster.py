"""K-means segmentation of items into bottleneck groups.

The five cluster features (lead time included, as in the reference) are
standardised with the population std, assembled once and checkpointed.
All fits of the k sweep share one scan per iteration (``kmeans.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import mean
from ..schema import CLUSTER_FEATURES
from ..session import materialise
from .features import standard_scale
from .kmeans import best_by_k, fit_all, silhouettes

SEED = 42


def cluster_matrix(items_df: DataFrame, cols=CLUSTER_FEATURES) -> DataFrame:
    """(sku, features = standardised cluster features), written."""
    scaled = standard_scale(items_df, cols, keep=("sku",))
    vec = VectorAssembler(inputCols=[f"{c}_scaled" for c in cols], outputCol="features").transform(scaled)
    return materialise(vec.select("sku", "features"), "cluster-matrix")


def _points(vec: DataFrame) -> DataFrame:
    return vec.select(vector_to_array("features").alias("x"))


def kmeans_sweep(vec: DataFrame, ks=range(2, 11), restarts: int = 10, seed: int = SEED) -> DataFrame:
    """(k, inertia, silhouette_sq): best of ``restarts`` seeds per k.

    All fits share one scan per iteration, and all silhouettes one more.
    Silhouette is the squared-Euclidean one (the exact Euclidean silhouette is
    quadratic in the rows)."""
    points = _points(vec)
    best = best_by_k(fit_all(points, ks, restarts, seed))
    rows = [(k, f.inertia[-1], s) for (k, f), s in zip(best.items(), silhouettes(points, list(best.values())), strict=True)]
    return vec.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double").orderBy("k")


def assign(vec: DataFrame, k: int = 4, restarts: int = 10, seed: int = SEED) -> tuple[DataFrame, list]:
    """(sku, cluster) with clusters numbered by ascending centre (features in
    order), so labels do not depend on the initialisation; and the centres.
    No rows give no clusters."""
    fits = best_by_k(fit_all(_points(vec), [k], restarts, seed))
    centres = sorted(list(map(float, c)) for f in fits.values() for c in f.centres)
    x = vector_to_array("features")
    if not centres:
        return vec.select("sku", F.lit(None).cast("int").alias("cluster")), []
    apart = [reduce(lambda a, b: a + b, [(x[i] - v) * (x[i] - v) for i, v in enumerate(c)]) for c in centres]
    best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(n).alias("n")) for n, d in enumerate(apart)]))
    return vec.select("sku", best["n"].alias("cluster")), centres


def nearest_centre(items_df: DataFrame, centres: list[dict[str, float]]) -> DataFrame:
    """(sku, cluster): the number of the nearest of the given centres (plain
    squared distance over a centre's columns, the first among ties)."""
    apart = [reduce(lambda a, b: a + b, [(F.col(c).cast("double") - v) * (F.col(c).cast("double") - v) for c, v in at.items()])
             for at in centres]
    best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(k).alias("k")) for k, d in enumerate(apart)]))
    return items_df.select("sku", best["k"].alias("cluster"))


def cluster_means(items_df: DataFrame, assigned: DataFrame, cols=CLUSTER_FEATURES, digits: int = 6,
                  half_even: bool = False) -> DataFrame:
    """Mean of each cluster feature and row count per cluster, by cluster;
    ``half_even`` rounds ties to the even digit."""
    j = items_df.join(assigned, "sku")
    rounded = F.bround if half_even else F.round
    return (j.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"),
                                     *[rounded(mean(c), digits).alias(c) for c in cols]).orderBy("cluster"))


def bottleneck_label(avg_defect: Column, avg_volume: Column, avg_lead: Column) -> Column:
    """First rule that holds: defects > 2.5, volume > 700, lead > 20."""
    return (F.when(avg_defect > 2.5, "Quality Issues").when(avg_volume > 700, "Production Volume")
            .when(avg_lead > 20, "Logistics").otherwise("Efficient"))


def cluster_profile(items_df: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per cluster: size, mean lead time / defect rate / volume / price, the
    modal product type and the primary bottleneck; by mean lead time.  A mean
    of a column that the items lack is NULL and decides no bottleneck; the
    product type is then 'N/A'."""
    j = items_df.join(assigned, "sku")
    has = set(items_df.columns)
    avg = lambda c: mean(c) if c in has else F.max(F.lit(None).cast("double"))
    kind = F.mode("product_type", True) if "product_type" in has else F.max(F.lit("N/A"))
    prof = j.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("count"), avg("lead_time").alias("avg_lead_time"),
        avg("defect_rates").alias("avg_defect_rate"), avg("production_volumes").alias("avg_production_volume"),
        avg("price").alias("avg_price"), kind.alias("product_types"))
    return (prof.withColumn("primary_bottleneck", bottleneck_label(F.col("avg_defect_rate"),
                                                                   F.col("avg_production_volume"),
                                                                   F.col("avg_lead_time")))
            .select("cluster", "count", *[F.round(c, 6).alias(c) for c in
                                          ("avg_lead_time", "avg_defect_rate", "avg_production_volume", "avg_price")],
                    "product_types", "primary_bottleneck")
            .orderBy(F.desc("avg_lead_time")))


def pca_2d(vec: DataFrame, assigned: DataFrame | None = None) -> tuple[DataFrame, list[float]]:
    """Rows projected on the first two principal components (the input is
    standardised, hence centred).  Each component's sign is fixed so its
    largest-magnitude loading is positive.  Returns the projections and the
    explained-variance ratios."""
    m = PCA(k=2, inputCol="features", outputCol="pc").fit(vec)
    pcm = m.pc.toArray()
    signs = [1.0 if pcm[abs(pcm[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    out = m.transform(vec).select("sku", vector_to_array("pc").alias("pc"))
    out = out.select("sku", (F.col("pc")[0] * signs[0]).alias("pc1"), (F.col("pc")[1] * signs[1]).alias("pc2"))
    if assigned is not None:
        out = out.join(assigned, "sku")
    return out, [float(v) for v in m.explainedVariance.toArray()]
