"""Connected components of an edge table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(a, b): for every node a of the undirected edges (a, b), but the smallest of its component, that smallest as b.

    The number of rounds grows with the logarithm of the longest path. Every
    round is written to the checkpoint folder; only its row count and a
    checksum come to the driver.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
                              F.coalesce(F.bit_xor(F.xxhash64("b", "a")), F.lit(0))).first())
        if now == seen or not now[0]:
            return edges
        seen = now
        edges = staged(_small_star(_large_star(edges)), name)
