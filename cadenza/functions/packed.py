"""Packed similarity lists.

The source stores each track's similar tracks as one string
``"id,score,id,score,..."`` and unpacks it in a driver-side index loop.  Here
the list is split and paired with higher-order array functions, then
exploded: all JVM-side and per row, so the work is spread like any scan.
An odd trailing id (no score) is ignored and counted in ``dangling``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_entries(target: Column | str) -> Column:
    """array<struct<target string, score double>> from a packed string."""
    c = F.col(target) if isinstance(target, str) else target

    def pairs(parts: Column) -> Column:
        n_pairs = F.floor(F.size(parts) / 2).cast("int")
        # sequence(0, -1) would count down, so lists without a pair give NULL
        return F.when(n_pairs > 0, F.transform(
            F.sequence(F.lit(0), n_pairs - 1),
            lambda i: F.struct(F.trim(F.get(parts, i * 2)).alias("target"),
                               F.trim(F.get(parts, i * 2 + 1)).try_cast("double").alias("score"))))
    # the split list is an argument of the outer lambda: one split a list, not
    # one for each of its entries
    return F.when(c.isNotNull(), F.get(F.transform(F.array(F.split(c, ",")), pairs), 0))


def dangling_count(target: Column | str) -> Column:
    c = F.col(target) if isinstance(target, str) else target
    return (F.size(F.split(c, ",")) % 2).cast("int")


def unpack_pairs(packed: DataFrame, tid: str = "tid", target: str = "target") -> DataFrame:
    """(tid, packed) -> (tid, target, score), one row per pair."""
    e = packed.select(F.col(tid).alias("tid"), F.explode(packed_entries(target)).alias("e"))
    return e.select("tid", F.col("e.target").alias("target"), F.col("e.score").alias("score"))
