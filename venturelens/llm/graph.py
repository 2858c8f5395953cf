"""Connected components of links between ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.operators.skew import union_rows
from venturelens.session import Scratch, shuffles_freed


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour (itself counted)."""
    both = union_rows([edges.select("a", "b"), edges.select(F.col("b").alias("a"), F.col("a").alias("b"))])
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return union_rows([others, least.select("a", F.col("m").alias("b"))]).filter("a <> b").distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``id, component``: every id of a link and the smallest id it can reach, from links ``a, b``.

    Each round is written to the shared folder, so a lost executor costs one round; the number of rounds grows with
    the logarithm of the longest chain. A node's links are joined, never gathered, so a hub can be split.
    """
    spark = links.sparkSession
    scratch = Scratch(spark)
    edges = scratch.store(links.select("a", "b").filter("a <> b").distinct(), "links-0")
    before = None
    for k in range(rounds):
        edges = scratch.store(_small_star(_large_star(edges)), f"links-{k + 1}")
        scratch.drop(f"links-{k}")
        with shuffles_freed(spark):
            state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components don't settle within {rounds} rounds")
    tops = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return union_rows([edges.select(F.col("a").alias("id"), F.col("b").alias("component")), tops])
