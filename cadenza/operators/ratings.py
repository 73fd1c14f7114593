"""Rating-table operators: profile (A1-A3), per-user max normalisation
(A4, J9, H8), min-max normalisation (X1), deterministic splits (U6, U7).

Per-user statistics are ``groupBy`` aggregates (partial + final) joined back
on the user key rather than unbounded window partitions: a user holding a
third of all plays is combined map-side, and the join back is a skewed key
on one side only, which AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.ids import HASH_BITS, hash_bucket


def dataset_profile(plays: DataFrame) -> DataFrame:
    """A1-A3: total rows, distinct users, distinct songs in one aggregate."""
    return plays.agg(F.count(F.lit(1)).alias("n_plays"),
                     F.countDistinct("user_id").alias("n_users"),
                     F.countDistinct("song_id").alias("n_songs"))


def user_max(plays: DataFrame, value: str = "play_count", key: str = "user_id") -> DataFrame:
    """A4: per-key max, zero-initialised (a key whose values are all
    negative gets 0)."""
    return plays.groupBy(key).agg(F.greatest(F.max(value).cast("double"), F.lit(0.0))
                                  .alias("max_value"))


def normalize_by_user_max(plays: DataFrame, value: str = "play_count",
                          key: str = "user_id", item: str = "song_id",
                          scale: float = 10.0) -> DataFrame:
    """H8: (user, song, 10 * value / user max).  A zero max gives NULL (no
    division error)."""
    mx = user_max(plays, value, key)
    j = plays.select(key, item, value).join(mx.hint("shuffle_hash"), key)   # no sort of the plays
    return j.select(key, item, F.col(value).alias("play_count"),
                    F.try_divide(F.col(value) * F.lit(float(scale)), F.col("max_value"))
                    .alias("norm_value"))


def normalize_min_max(plays: DataFrame, value: str = "play_count",
                      key: str = "user_id", item: str = "song_id") -> DataFrame:
    """(value - min) / (max - min) per user; NULL when max == min."""
    mm = plays.groupBy(key).agg(F.min(value).cast("double").alias("_lo"),
                                F.max(value).cast("double").alias("_hi"))
    j = plays.select(key, item, value).join(mm, key)
    return j.select(key, item, F.col(value).alias("play_count"),
                    F.when(F.col("_hi") > F.col("_lo"),
                           F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")))
                    .alias("norm_value"))


def split_flag(keys: Sequence[str], fraction: float, seed: int):
    """True for rows in the first part of a deterministic split."""
    limit = int(round(fraction * (1 << HASH_BITS)))
    return hash_bucket(*keys, seed=seed) < F.lit(limit)


def hash_split(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 1):
    """Deterministic (first, rest) split by an md5 bucket of ``keys``.

    No shuffle and no complement computation: both parts are filters of the
    same scan, stable under any repartitioning, and reproducible in SQL.
    """
    flag = split_flag(keys, fraction, seed)
    return df.where(flag), df.where(~flag)


def seeded_random_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str],
                        seed: int = 1) -> list[DataFrame]:
    """U7 as ``randomSplit`` with a seed.  Rows are sorted by ``keys`` inside
    each partition first, so the split repeats for the same partitioning
    (``hash_split`` is the form that repeats under any partitioning)."""
    return df.sortWithinPartitions(*keys).randomSplit(list(weights), seed)


def normalize_rejects(plays: DataFrame, value: str = "play_count", key: str = "user_id"
                      ) -> DataFrame:
    """Q2: users whose maximum is not positive (their normalised values are
    NULL), with the number of rows affected."""
    return (plays.groupBy(key).agg(F.max(value).alias("_mx"), F.count(F.lit(1)).alias("n_rows"))
            .where(~(F.col("_mx") > 0) | F.col("_mx").isNull())
            .select(key, "n_rows", F.lit("non-positive maximum").alias("reason")))
