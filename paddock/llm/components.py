"""Connected components of a graph of long ids by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import materialise


def _is_stars(e: DataFrame) -> bool:
    """Every node has one edge to a smaller one, or is the smaller end of edges only."""
    above = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    both = above.join(e.select(F.col("v").alias("u"), F.lit(1).alias("low")).distinct(), "u", "left")
    return both.where("n > 1 or low = 1").isEmpty()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node of its component) of every node of ``edges`` (``a``, ``b``).

    Each round replaces edges by edges to smaller neighbours; the number of rounds grows with the
    logarithm of the graph's size, and a round is aggregations (combined map-side) and joins that may
    split a node with very many neighbours.  Every round is written, so lineage stays short."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(spark, e, "edges")
    while not _is_stars(e):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(spark, small, "edges")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
