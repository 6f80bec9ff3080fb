"""The design matrix as sparse rows.

The levels of the category columns are a stored table (feature number, column,
level, name), made by one distinct aggregate and numbered without a
single-task sort; neither levels nor feature names pass through the driver.
Each category column is joined to its levels, so a row gets one feature number
per column, and the rows are written as sparse vectors.  A row's size depends
on the number of columns, not on the number of levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.ids import numbered
from ..schema import DEFECT_BIN_LABELS, TARGET, VOLUME_QUARTILE_LABELS
from ..session import materialise
from .joins import join_lookup
from .quality import string_columns

#: Ordered categories keep their label order, unused labels too.
CATEGORY_LEVELS = {"defect_rate_category": DEFECT_BIN_LABELS,
                   "production_volume_category": VOLUME_QUARTILE_LABELS}


def level_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, column, level, name): every level but the first of each
    category column, features numbered from 0 by column, then level.  NULL is
    no level."""
    spark = df.sparkSession
    plain = [c for c in cols if c not in CATEGORY_LEVELS]
    fixed = [(k, c, i, lv) for k, c in enumerate(cols) if c in CATEGORY_LEVELS
             for i, lv in enumerate(CATEGORY_LEVELS[c]) if i]
    out = spark.createDataFrame(fixed, "at int, column string, place int, level string")
    if plain:
        parts = [F.struct(F.lit(cols.index(c)).alias("at"), F.lit(c).alias("column"), F.lit(0).alias("place"),
                          F.col(c).cast("string").alias("level")) for c in plain]
        found = materialise(df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
                            .where(F.col("level").isNotNull()).distinct(), "levels")
        first = found.groupBy("at").agg(F.min("level").alias("first"))
        out = out.unionByName(found.join(first, "at").where(F.col("level") > F.col("first")).drop("first"))
    return numbered(out, ["at", "place", "level"], "feature", start=0).select(
        "feature", "column", "level", F.concat_ws("_", "column", "level").alias("name"))


def with_features(df: DataFrame, cols: list[str], levels: DataFrame) -> DataFrame:
    """``df`` with ``__f_{column}``: the number of the row's level, NULL for
    the first level and for NULL."""
    for c in cols:
        of = levels.where(F.col("column") == c).select(F.col("level").alias("__level"), F.col("feature").alias(f"__f_{c}"))
        df = join_lookup(df, of, F.col(c).cast("string") == F.col("__level"), "left").drop("__level")
    return df


def one_hot_drop_first(df: DataFrame, cols: list[str] | None = None, key: str = "sku") -> DataFrame:
    """``pd.get_dummies(drop_first=True)`` in long form: (key, feature, value)
    with value 1 for each row's level of each column, without the first level
    of a column, and without the zeros."""
    cols = cols or [c for c in string_columns(df) if c != key]
    levels = level_table(df, cols)
    coded = with_features(df.select(key, *cols), cols, levels)
    found = coded.select(key, F.explode(F.array(*[F.col(f"__f_{c}") for c in cols])).alias("at")).where("at IS NOT NULL")
    names = levels.select(F.col("feature").alias("at"), F.col("name").alias("feature"))
    return join_lookup(found, names, "at", "inner").select(key, "feature", F.lit(1).alias("value"))


@dataclass
class Design:
    """``rows``: key, kept columns, label, features (sparse vector), dense
    (numeric features) and codes (feature numbers of the row's levels, -1 for
    none); ``names``: (feature, name); ``width``: number of features."""

    rows: DataFrame
    names: DataFrame
    width: int


def design_matrix(features: DataFrame, target: str = TARGET, key: str = "sku", keep: tuple[str, ...] = ()) -> Design:
    """The design matrix of every column but the key, the target and ``keep``
    (passed through untouched): numeric columns as they are (NULL is NaN),
    category columns as drop-first dummies behind them."""
    cats = [c for c in string_columns(features) if c not in (key, *keep)]
    nums = [c for c in features.columns if c not in (key, target, *keep, *cats)]
    n = len(nums)
    levels = materialise(level_table(features, cats).withColumn("feature", (F.col("feature") + n).cast("int")), "level-table")
    width = n + levels.count()
    names = features.sparkSession.createDataFrame(list(enumerate(nums)), "feature int, name string").unionByName(
        levels.select("feature", "name"))
    coded = with_features(features, cats, levels)
    codes = [F.col(f"__f_{c}") for c in cats]
    number = lambda c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))
    dense = F.array(*[number(c) for c in nums]).cast("array<double>")
    hot = F.filter(F.array(*codes).cast("array<int>"), lambda x: x.isNotNull())
    places = F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>")
    rows = coded.select(
        key, *keep, F.col(target).cast("double").alias("label"), sparse_vector(
            F.lit(width), F.concat(places, hot), F.concat(dense, F.transform(hot, lambda x: F.lit(1.0)))).alias("features"),
        dense.alias("dense"), F.array(*[F.coalesce(c, F.lit(-1)) for c in codes]).cast("array<int>").alias("codes"))
    return Design(as_vectors(rows, "features", "design"), names, width)


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """The stored form of a sparse vector; ``indices`` ascend."""
    return F.struct(F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"),
                    indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def as_vectors(rows: DataFrame, col: str, tag: str) -> DataFrame:
    """``rows``, written, with the stored vectors of ``col`` read as vectors."""
    fields = [StructField(f.name, VectorUDT() if f.name == col else f.dataType, f.nullable) for f in rows.schema]
    return materialise(rows, tag, StructType(fields))
