"""Connected components by alternating stars, for links between 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Large star: each node's greater neighbours move to its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("least")
    )
    moved = both.filter("b > a").join(least, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Small star: each node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), "least"
    )
    moved = down.join(least, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    ).filter("a != b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node root``: the least id that each linked node reaches, for links ``a b``.

    Each round is two aggregates and two joins, whose result is written out; a
    node with many links is combined before the shuffle and split in the join.
    """
    edges = stored(links.filter("a != b").distinct(), "edges")
    before = None
    # Roots only ever fall, and each round that changes nothing is the last.
    while True:
        edges = stored(_small_star(_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
