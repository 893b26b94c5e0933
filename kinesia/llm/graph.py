"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a shuffle with map-side aggregation, written to the shared folder so
that lineage stays short and a lost executor costs one step. A star around a hub of
any degree never meets in one task as a list: a step only takes the minimum
neighbour of each node and joins it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.session import shared_dir


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:  # from each node to its smaller neighbours
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    linked = both.join(low, both.u == low.k)
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("k").alias("a"), F.col("m").alias("b"))
        )
    return out.filter("a != b").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node of edges a > b has one edge to a smaller node, or only edges to larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down + up > 1").isEmpty()


def components(spark: SparkSession, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    ``edges`` holds integer ids; loops, nulls, repeats and either direction are
    allowed. Nodes without an edge to another node are not returned. The steps end
    when the edges are stars around the smallest node, which may be so at the start.
    """
    now = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"), (F.col(a) != F.col(b)).alias("_edge"))
    now = stored(spark, now.filter("_edge").drop("_edge").distinct(), "components")
    while not _is_stars(now):
        now = stored(spark, _star(_star(now, True), False), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
