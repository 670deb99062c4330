"""Connected components of a graph that is only ever held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its least neighbour."""
    near = _both_ways(edges)
    least = near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    return (
        near.where("b > a")
        .join(least, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.least("least", "node").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them. Rows have ``a > b``."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = edges.join(least, F.col("a") == F.col("node"))
    return (
        joined.where("b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it reaches; nodes are those of ``edges`` (a, b: long).

    Alternating star contractions: every round halves the depth of what is left,
    each is two grouped minima and two joins, and its result is checkpointed. A
    node with very many edges only ever meets its minimum, which is summed up
    before the shuffle; the join with it can be split.
    """
    stars = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    seen = stars.agg(F.count("*"), mark).first()
    while seen[0]:
        stars = cut(_small_star(_large_star(stars)).distinct())
        now = stars.agg(F.count("*"), mark).first()
        if now == seen:
            break
        seen = now
    rooted = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rooted.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
