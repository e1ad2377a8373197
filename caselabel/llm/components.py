"""Connected components of an edge table by alternating stars, wholly in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm.tables import written


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    near = both.where("b > a").join(least, "a")
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with an edge; a component is named by its least node.

    ``edges`` has two long columns ``a, b`` in any order, repeats and loops
    allowed.  Each round at least squares away path length, so rounds grow with
    the logarithm of the longest path.  Round results are written tables; a
    node with very many neighbours only meets partial minima and joins whose
    large partitions Spark can split.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = written(now, "links"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        now = written(_smaller_to_least(written(_larger_to_least(now), "links")), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
