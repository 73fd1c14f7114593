"""Array-shaped song data: ragged-array slicing (P27), timbre summaries
(X2, X3), user profiles (X9), missing-feature handling (X4, X5).

P27 re-aims the per-file accessor of the raw song format: record *i* of a
file owns ``flat[start_i : start_{i+1}]`` and the last record runs to the
end.  A file is one row with its flat array and its offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ragged_slice(files: DataFrame, file: str = "file", values: str = "vals",
                 starts: str = "starts") -> DataFrame:
    """(file, rec, n, vals) from one row per file with its flat values
    and the start of each record (0-based).

    Record i is ``values[starts[i] : starts[i + 1]]``, the last one runs to
    the end; a record may be empty.  ``slice`` within the row: no shuffle.
    """
    length = F.size(values)
    nxt = F.coalesce(F.get(F.col("_starts"), F.col("rec") + 1), F.col("_len"))
    rows = (files.select(F.col(file), F.col(values).alias("_vals"), F.col(starts).alias("_starts"),
                         length.alias("_len"))
            .select("*", F.posexplode("_starts").alias("rec", "_start"))
            .withColumn("n", F.greatest(nxt - F.col("_start"), F.lit(0))))
    return rows.select(file, F.col("rec").cast("bigint").alias("rec"),
                       F.col("n").cast("bigint").alias("n"),
                       F.slice("_vals", (F.col("_start") + 1).cast("int"), F.col("n").cast("int")).alias("vals"))


def array_mean(arr: Column | str, start: int, length: int) -> Column:
    """Mean of ``length`` array elements from 1-based ``start``."""
    a = F.slice(F.col(arr) if isinstance(arr, str) else arr, start, length)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)


def segment_stats(df: DataFrame, key: str, arr: str, dims: int) -> DataFrame:
    """Per key, the mean of each dimension and the covariance of every
    pair of dimensions over the segments of the whole array.

    The array is cut into rows of ``dims`` values (segment-major); the last
    segment may be short, a pair counts where a segment has both.  One row
    per key and pair (i, j), i <= j, both from 1: ``dims * (dims + 1) / 2``
    rows, i = j being the variance.  The segments are exploded once and all
    pairs are aggregates of that row, so there is no join of dimensions.
    """
    n_seg = F.ceil(F.size(arr) / F.lit(dims)).cast("int")
    seg = (df.where(F.size(arr) > 0)
           .select(key, arr, F.explode(F.sequence(F.lit(0), n_seg - 1)).alias("_s"))
           .select(key, *[F.get(arr, F.col("_s") * dims + k).cast("double").alias(f"_v{k}")
                          for k in range(dims)]))
    pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
    agg = seg.groupBy(key).agg(
        *[F.avg(f"_v{i}").alias(f"_m{i}") for i in range(dims)],
        *[F.covar_pop(f"_v{i}", f"_v{j}").alias(f"_c{i}_{j}") for i, j in pairs])
    cells = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("i"), F.lit(j + 1).cast("bigint").alias("j"),
                               F.col(f"_m{i}").alias("avg_i"), F.col(f"_c{i}_{j}").alias("cov"))
                      for i, j in pairs])
    return agg.select(key, F.inline(cells))


def user_profile(plays: DataFrame, item_features: DataFrame, features: Sequence[str],
                 item_key: str = "track_id", play_item: str = "song_id") -> DataFrame:
    """Per user, the play-weighted mean of item features:
    sum(f * plays) / sum(plays)."""
    j = plays.join(item_features, plays[play_item] == item_features[item_key])
    w = F.col("play_count").cast("double")
    aggs = [(F.sum(F.col(f) * w) / F.sum(w)).alias(f"profile_{f}") for f in features]
    return j.groupBy("user_id").agg(*aggs)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows lacking any of ``cols``."""
    return df.dropna(subset=list(cols))


def impute_midrange(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Fill NULLs of each column with the middle of its declared range
    (the attribute's own, not the observed one): no pass over the data."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit((float(lo) + float(hi)) / 2.0))
              for c, (lo, hi) in bounds.items()}
    return df.withColumns(filled)


def user_cosine(plays: DataFrame, requests: DataFrame, user: str = "user_id",
                item: str = "song_id", value: str = "play_count") -> DataFrame:
    """Cosine similarity of each request user to every other user over
    co-rated items: sum(a*b) / sqrt(sum(a^2) * sum(b^2)), sums over the items
    both played.

    Work is the number of (request user, item, other rater) triples — linear
    in the plays for a fixed request table; an all-users x all-users table
    (quadratic in each item's raters) is deliberately not offered.  A popular
    item is a skewed join key on the plays side only (AQE skew join).
    """
    mine = plays.join(requests.select(user).distinct(), user, "left_semi").select(
        F.col(user).alias("user_id"), F.col(item).alias("_item"),
        F.col(value).cast("double").alias("a"))
    others = plays.select(F.col(user).alias("other_user_id"), F.col(item).alias("_item"),
                          F.col(value).cast("double").alias("b"))
    j = mine.join(others, "_item").where(F.col("user_id") != F.col("other_user_id"))
    agg = j.groupBy("user_id", "other_user_id").agg(
        F.count(F.lit(1)).alias("n_common"),
        F.sum(F.col("a") * F.col("b")).alias("_dot"),
        F.sum(F.col("a") * F.col("a")).alias("_na"),
        F.sum(F.col("b") * F.col("b")).alias("_nb"))
    return agg.select("user_id", "other_user_id", "n_common",
                      F.try_divide(F.col("_dot"), F.sqrt(F.col("_na") * F.col("_nb")))
                      .alias("cosine"))
