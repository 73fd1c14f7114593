"""Connected components by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import settled

EDGES_A_TASK = 5_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the least node reachable.

    Large-star and small-star steps in turn: each node's larger, then smaller
    neighbours are tied to the least of its neighbourhood.  The number of
    rounds grows with the logarithm of the nodes, the edges never grow beyond
    their first number, and every step pre-aggregates before its shuffle.
    """
    now = settled(edges.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        # few edges need few tasks; their number never grows
        now = now.coalesce(-(-mark[0] // EDGES_A_TASK))
        # (explode, not union: one partition stays one)
        both = now.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
                          .alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(root, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        now = settled(small)
        was, mark = mark, _mark(now)
        if was == mark:
            break
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    r = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"),
                  F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(r)
