"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, ensure_checkpoint_dir, shuffles_freed
from ..sources.tables import read_table

# ASCII white space that separates words (fixed by the task's word pattern).
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage: what reads the result reads files, so a lost executor
    costs a reread and not a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    schema = df.schema
    with shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.written_at = path
    return out


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def integers_as_text(df: DataFrame) -> DataFrame:
    """Integer columns as text: pandas would turn them into doubles beside a
    null, which rounds numbers above 2^53."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if t in INTEGERS else F.col(f"`{c}`") for c, t in df.dtypes])


def integers_again(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns that ``integers_as_text`` turned into text, as they were in
    ``like``."""
    kinds = {c: t for c, t in like.dtypes if t in INTEGERS}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """Connected components of an edge list (columns ``u``, ``v``, longs).

    Returns (node, component): component is the smallest node reachable.
    Every round hooks each node to its smallest neighbour, follows the
    pointers twice and contracts the edges, so at least every second node
    with an edge leaves the list per round; rounds are logarithmic.  Minima
    are partially aggregated and the joins are plain equi-joins, so a node
    with very many links costs one row per task.  Empty edges give an empty
    table; self-loops give the node itself.
    """
    e = materialise(
        edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{tag}-edges")
    nodes = materialise(
        e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        .select("node", F.col("node").alias("component")), f"{tag}-nodes")
    whole, e = e, e.where("u <> v")
    while not e.isEmpty():
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hop = materialise(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), f"{tag}-hop")
        # a node's pointer never rises, so following it twice stays inside the component
        second = hop.select(F.col("u").alias("p"), F.col("p").alias("q"))
        jump = materialise(
            hop.join(second, "p").select("u", F.col("q").alias("p"))
            .join(second, "p").select("u", F.col("q").alias("p")), f"{tag}-jump")
        moved = materialise(
            nodes.join(jump.select(F.col("u").alias("component"), "p"), "component", "left")
            .select("node", F.coalesce("p", "component").alias("component")), f"{tag}-nodes")
        left = jump.select("u", F.col("p").alias("a"))
        right = jump.select(F.col("u").alias("v"), F.col("p").alias("b"))
        rest = materialise(
            e.join(left, "u").join(right, "v").where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), f"{tag}-edges")
        discard(whole, nodes, hop, jump)
        nodes, e, whole = moved, rest, rest
    discard(whole)
    # hooks always go to smaller nodes and contraction keeps the smallest, so the root is the minimum
    return nodes
