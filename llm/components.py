"""Connected components of a large edge table by alternating large and small stars, in Spark joins and sums only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import materialize


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (a, b) with a < b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
    # small star: every node hands its lesser neighbours to the least of them
    small = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    moved = large.join(small, F.col("b") == F.col("u")).select("m", F.col("a").alias("v"))
    return moved.unionByName(small.select("m", F.col("u").alias("v"))).where("m < v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """(node, label) of every node that has an edge; label is the least node of its component.

    Edges are pairs a, b of longs; loops and repeats do no harm. Every round writes its edges to the shared folder, so
    lineage stays short; `keep` writes them. Rounds grow with the logarithm of the longest chain.
    """
    e = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    state = None
    while True:
        seen = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state or not seen.n:
            break
        state = seen
        e = keep(_round(e), "edges")
    return e.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
