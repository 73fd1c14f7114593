"""Id operators: hash dimension (P11), collision report, un-hash join (J3),
nested triplet form (P26), and collision-free dense ids.

``global_positions`` numbers rows 0..n-1 in a total order without a
single-partition window and without moving rows through Python: a range
sort, ``monotonically_increasing_id`` inside each partition, and per-
partition offsets from a table that has one row per partition (broadcast,
so its size is bounded by the partition count, not by the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.ids import stable_hash28

_POS_BITS = 33  # monotonically_increasing_id layout: partition index << 33


def global_positions(df: DataFrame, keys: Sequence[str], out: str = "pos",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in the order of ``keys``.

    Ties on ``keys`` get distinct but arbitrary positions.  The sorted data
    is checkpointed to the shared checkpoint folder, so positions are fixed
    for every later use of the result.

    The range sort uses ``num_partitions`` or ``spark.sql.shuffle.partitions``
    ranges; AQE may merge small ranges but never splits one, so on a cluster
    that setting (or the argument) must be sized to the input (~128-256 MB
    per range).
    """
    keys = list(keys)
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    s = (ranged.sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    pid = F.shiftright("_mid", _POS_BITS)
    per = s.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"),
                                           F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select("_pid", "_m0",
                     F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(off), pid == off._pid)
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("bigint"))
            .drop("_mid", "_pid", "_m0", "_off"))


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """Collision-free int ids for the distinct values of ``col`` (0..n-1, in
    value order): a mapping table (col, out)."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_positions(d, [col], out).withColumn(out, F.col(out).cast("int"))


def hash_dimension(songs: DataFrame, col: str = "song_id") -> DataFrame:
    """(song_id, hash_id), de-duplicated at build (the source kept
    duplicates and hid them later with a distinct)."""
    return songs.select(F.col(col).alias("song_id"),
                        stable_hash28(col).alias("hash_id")).distinct()


def collisions(dim: DataFrame) -> DataFrame:
    """Ids sharing one hash: (hash_id, song_id, n_ids) for every hash that
    more than one id maps to.  Counting is an aggregate, so no hash group
    is ever collected."""
    n = dim.groupBy("hash_id").agg(F.countDistinct("song_id").alias("n_ids")) \
        .where(F.col("n_ids") > 1)
    return dim.join(n, "hash_id").select("hash_id", "song_id",
                                         F.col("n_ids").cast("bigint").alias("n_ids"))


def unhash(scored: DataFrame, dim: DataFrame, hash_col: str = "product") -> DataFrame:
    """Map hashed item ids back to source ids.  A hash collision fans
    out to every id sharing it (all are returned, as in the source)."""
    return scored.join(dim, scored[hash_col] == dim.hash_id).drop("hash_id")


def triplet_struct(plays: DataFrame) -> DataFrame:
    """Nested form {user:{id,hash}, song:{id,hash}, rating}."""
    return plays.select(
        F.struct(F.col("user_id").alias("id"), stable_hash28("user_id").alias("hash"))
        .alias("user"),
        F.struct(F.col("song_id").alias("id"), stable_hash28("song_id").alias("hash"))
        .alias("song"),
        F.col("play_count").cast("double").alias("rating"))


def flatten_triplets(nested: DataFrame) -> DataFrame:
    """The flat (user_hash, song_hash, rating) form, ids kept alongside."""
    return nested.select(F.col("user.id").alias("user_id"), F.col("user.hash").alias("user_hash"),
                         F.col("song.id").alias("song_id"), F.col("song.hash").alias("song_hash"),
                         "rating")
