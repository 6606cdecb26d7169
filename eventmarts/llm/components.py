"""Connected components of a large edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import written


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: nothing is left to move."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("edges"), F.lit(0).alias("pointed")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("edges"), F.lit(1).alias("pointed")),
    )).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.sum("edges").alias("edges"), F.max("pointed").alias("pointed"))
    return nodes.filter("edges + pointed > 1").isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): every node of an edge table (a, b) with the smallest node it can reach, itself left out.

    Each round is a few joins and sums; its result is written to the shared folder, so no lineage
    grows and nothing goes through the driver.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "stars")
    while not _settled(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        edges = written(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "stars")
    return edges
