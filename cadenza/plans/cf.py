"""Collaborative filtering with ``pyspark.ml`` ALS.

* Ids: collision-free dense ints from ``global_positions`` (ALS needs int32).
* Top-N for the users of a request table (``inner_product.top_lists``): the
  source serves one user at a prompt, so work is requests x items at most, never
  all users x items.
* Grid search: a driver loop over *settings* (each fit is distributed); the
  training ratings are persisted because every fit rescans them, and the
  results come back as a DataFrame of one row per setting.
* Lineage: ALS checkpoints its factor RDDs into the session's shared checkpoint
  folder, in a grid and on many ratings every second iteration, and a grid drops
  each model that is not the best one so far, so the shuffle files of finished
  iterations and settings leave the disks.
* Memory: the library holds the blocks of a task as plain objects, beside what
  Spark counts.  Of many ratings nothing is cached in memory (``sized``), as
  cached rows would take the room of these blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.ids import stable_hash28
from cadenza.operators.ids import dense_ids
from cadenza.operators.inner_product import top_lists
from cadenza.operators.metrics import error_metrics
from cadenza.operators.similar import REC_COLUMNS
from cadenza.operators.topk import dedupe_keep_best, top_k_per
from cadenza.session import free_dropped

SEED = 42
CHECKPOINT = 2   # iterations; at a checkpoint ALS deletes the shuffle files before it
IN_MEMORY = 5_000_000          # ratings; of more, rows and blocks are kept on disk
RATINGS_A_BLOCK = 24_000_000   # in mean: a task needs some 45 bytes of memory for each


def als_ratings(plays: DataFrame, value: str = "play_count", id_mode: str = "dense",
                ids_of: DataFrame | None = None, keep: Sequence[str] = ("user_id", "song_id")):
    """(ratings(user_ix, item_ix, rating, user_id, song_id), user map, item map).

    ``id_mode='dense'``: collision-free 0..n-1 ids.  ``id_mode='hash'``: the
    source's scheme, a 28-bit hash of each id (fits int32; colliding ids
    share one ALS row, and mapping back through the map fans out to all of
    them, as the source's un-hash join does).  ``ids_of`` names a cheaper table
    with the users and songs of ``plays``, from which the dense ids are made;
    ``keep``, the columns of ``plays`` that stay beside the three of the ratings.
    """
    if id_mode == "dense":
        ids_of = plays if ids_of is None else ids_of
        users = dense_ids(ids_of, "user_id", "user_ix")
        items = dense_ids(ids_of, "song_id", "item_ix")
    elif id_mode == "hash":
        users = plays.select("user_id", stable_hash28("user_id").cast("int").alias("user_ix")) \
            .distinct()
        items = plays.select("song_id", stable_hash28("song_id").cast("int").alias("item_ix")) \
            .distinct()
    else:
        raise ValueError(id_mode)
    # a task's share of a map is small: hashed, it spares sorting the plays by id
    r = plays.select("user_id", "song_id", F.col(value).cast("float").alias("rating"), *set(keep) - {"user_id", "song_id"})
    r = (r.join(users.hint("shuffle_hash"), "user_id").join(items.hint("shuffle_hash"), "song_id")
         .select("user_ix", "item_ix", "rating", *keep))
    return r, users, items


def make_als(rank: int = 8, reg: float = 1.0, iters: int = 10, alpha: float = 1.0,
             implicit: bool = True) -> ALS:
    return ALS(userCol="user_ix", itemCol="item_ix", ratingCol="rating", rank=rank,
               regParam=reg, maxIter=iters, alpha=alpha, implicitPrefs=implicit,
               coldStartStrategy="drop", nonnegative=False, seed=SEED,
               checkpointInterval=10)


def fit_als(als: ALS, ratings: DataFrame) -> ALSModel:
    """``als`` fitted to the three rating columns, which are kept meanwhile: the
    library counts the partitions of its input for its log before it reads it,
    and either step alone runs the joins that make the ratings."""
    columns = ["user_ix", "item_ix", "rating"]
    rows = ratings.select(columns).persist(StorageLevel.DISK_ONLY)
    n = rows.count()
    # (a filter that keeps all: the same plan would be found as cached already)
    kept = rows.where(F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK) if n <= IN_MEMORY else rows
    try:
        return sized(als, n).fit(kept)
    finally:
        kept.unpersist()
        rows.unpersist()


def sized(als: ALS, n: int) -> ALS:
    """``als`` for ``n`` ratings.  Of more than ``IN_MEMORY``, blocks and factors
    are kept on disk, and finished iterations leave it.  The library's ten blocks are enough for ten times
    ``RATINGS_A_BLOCK``; beyond, they follow the ratings (the starting factors
    are drawn by block)."""
    blocks = max(als.getNumUserBlocks(), -(-n // RATINGS_A_BLOCK))
    als = als.copy().setNumBlocks(blocks)
    if n > IN_MEMORY:
        als.setCheckpointInterval(CHECKPOINT).setIntermediateStorageLevel("DISK_ONLY").setFinalStorageLevel("DISK_ONLY")
    return als


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """M4: predicted score for given (user_ix, item_ix) pairs; unknown ids
    drop out (cold-start strategy 'drop')."""
    return model.transform(pairs)


def score_named(model: ALSModel, pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """M4 with the pairs' ids: each map joins where the rows lie by its number
    for the factors anyway, so ids cost the pairs no exchange of their own."""
    return score_pairs(model, pairs.join(users, "user_ix")).join(items, "item_ix")


def _listed(model: ALSModel, requests: DataFrame, n: int) -> DataFrame:
    """(user_ix, als_rank, item_ix, rating, best): the lists of length n of the
    users in ``requests`` (user_ix); ``best`` is the list's first rating, taken
    before the rows are exploded.

    A list is merged in its request's task, and only whole lists leave it; the
    library's blocked top-N sends n entries of every pair of blocks instead.
    """
    asked = model.userFactors.join(requests.select(F.col("user_ix").alias("id")), "id", "left_semi")
    rec = top_lists(asked, model.itemFactors, n, lag=1).checkpoint(eager=True)   # a row a request
    e = rec.select(F.col("id").alias("user_ix"), F.get("ratings", F.lit(0)).cast("double").alias("best"),
                   F.posexplode(F.arrays_zip("items", "ratings")).alias("p", "r"))
    return e.select("user_ix", (F.col("p") + 1).cast("bigint").alias("als_rank"),
                    F.col("r.items").alias("item_ix"),
                    F.col("r.ratings").cast("double").alias("rating"), "best")


def recommend_subset(model: ALSModel, requests: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The n best items of the users in ``requests`` (user_id, user_ix) as
    rows (user_id, song_id, als_rank, rating).  Work is requests x items."""
    rows = _listed(model, requests, n)
    return rows.join(requests, "user_ix").join(items, "item_ix").select(
        "user_id", "song_id", "als_rank", "rating")


def collaborative_recommendations(model: ALSModel, requests: DataFrame, items: DataFrame,
                                  songs: DataFrame, n: int = 1000, k: int = 20,
                                  exclude_played: DataFrame | None = None) -> DataFrame:
    """H2 = T6 -> P23 -> J3 -> P3 -> J4 -> U5 -> T2 for the users in
    ``requests`` (user_id, user_ix), in one pass over lists of length n.

    Items are joined to the catalogue once, as one dimension; user numbers
    become ids after the cut to k.  The source computes each user's played
    songs but never removes them; pass the plays as ``exclude_played`` to drop
    them (after the rescale, so scores keep the source's scale).
    """
    dim = items.join(songs.select("song_id", *REC_COLUMNS[:-1]), "song_id")
    rows = _listed(model, requests, n)
    scored = rows.select("user_ix", "item_ix", F.when(F.col("best") > 0, F.try_divide(
        F.col("rating") * F.lit(10.0), F.col("best"))).alias("predicted_score"))
    if exclude_played is not None:
        played = (exclude_played.select("user_id", "song_id").join(requests, "user_id")
                  .join(items, "song_id").select("user_ix", "item_ix"))
        scored = scored.join(played, ["user_ix", "item_ix"], "left_anti")
    full = scored.join(dim, "item_ix").select("user_ix", *REC_COLUMNS)
    best = dedupe_keep_best(full, ["user_ix", "title", "artist_name"],
                            [("predicted_score", "desc"), ("track_id", "asc")])
    top = top_k_per(best, ["user_ix"], [F.col("predicted_score").desc(), F.col("track_id").asc()], k)
    return top.join(requests, "user_ix").select("user_id", "rank", *REC_COLUMNS)


def listed_recommendations(rec: DataFrame, songs: DataFrame, k: int = 20) -> DataFrame:
    """H2 from lists that are already made (``recommend_subset``): rescale,
    catalogue, one row per (title, artist), top k."""
    best = rec.where(F.col("als_rank") == 1).select("user_id", F.col("rating").alias("best"))
    scored = rec.join(best, "user_id").select("user_id", "song_id", F.when(F.col("best") > 0, F.try_divide(
        F.col("rating") * F.lit(10.0), F.col("best"))).alias("predicted_score"))
    full = scored.join(songs.select("song_id", *REC_COLUMNS[:-1]), "song_id").select("user_id", *REC_COLUMNS)
    one = dedupe_keep_best(full, ["user_id", "title", "artist_name"],
                           [("predicted_score", "desc"), ("track_id", "asc")])
    return top_k_per(one, ["user_id"], [F.col("predicted_score").desc(), F.col("track_id").asc()], k).select(
        "user_id", "rank", *REC_COLUMNS)


# The source's grid, 3 x 9 x 4 = 108 settings of 20 iterations.
FULL_GRID = {"ranks": (8, 10, 12),
             "regs": (1.0, 3.0, 5.0, 7.0, 9.0, 11.0, 13.0, 15.0, 17.0),
             "alphas": (1.0, 10.0, 50.0, 100.0), "iters": (20,)}


def grid_search(spark: SparkSession, ratings: DataFrame,
                ranks: Sequence[int] = FULL_GRID["ranks"], regs: Sequence[float] = FULL_GRID["regs"],
                alphas: Sequence[float] = FULL_GRID["alphas"],
                iters: Sequence[int] = FULL_GRID["iters"], implicit: bool = True, fraction: float = 0.8, seed: int = 1,
                validate_on: DataFrame | None = None, results: str | None = None,
                parallelism: int = 1) -> tuple[DataFrame, ALSModel, dict]:
    """M3 / H7: fit every setting on the training part, score the held-out
    part, return (results DataFrame, best model, best setting).  By default
    the source's whole grid; a caller may pass fewer values.

    The ratings are kept once, on disk and as numbers with the split's flag, so
    neither the plays nor the id joins are computed again for a setting.  Selection is by hold-out RMSE, as in the source.  ``validate_on``
    overrides the held-out part (e.g. the full file, as the source's final
    evaluation does).

    ``results`` names a folder (shared) that keeps a row for every finished
    setting, written as soon as it is known: a search that starts again after
    the driver was lost reads it, skips these settings and fits the rest.  The
    folder belongs to one set of ratings and one split.  ``parallelism``
    settings are fitted at a time, as Spark jobs of one session.
    """
    from cadenza.operators.ratings import split_flag
    kept = ratings.select("user_ix", "item_ix", "rating", split_flag(["user_id", "song_id"], fraction, seed).alias("flag"))
    kept = kept.persist(StorageLevel.DISK_ONLY)
    n_ratings = kept.count()
    train = kept.where("flag").drop("flag")
    valid = validate_on if validate_on is not None else kept.where("not flag")
    known = {_setting(r): r for r in _finished(spark, results)} if results else {}

    def measured(setting: tuple) -> tuple[dict, ALSModel | None]:
        if setting in known:
            return known[setting], None
        rank, reg, alpha, it = setting
        model = sized(make_als(rank, reg, it, alpha, implicit), n_ratings).setCheckpointInterval(CHECKPOINT).fit(train)
        pred = score_pairs(model, valid.select("user_ix", "item_ix", "rating"))
        m = error_metrics(pred.select(F.col("rating").cast("double").alias("actual"),
                                      F.col("prediction").cast("double").alias("predicted"))
                          ).first()
        row = dict(rank=rank, reg_param=reg, alpha=alpha, max_iter=it,
                   n=int(m["n"]), mse=m["mse"], rmse=m["rmse"], mae=m["mae"])
        if results:
            # a folder a setting, as several may be written at a time
            spark.createDataFrame([row], GRID_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
                f"{results.rstrip('/')}/" + "-".join(map(str, setting)))
        return row, model

    settings = [(int(rank), float(reg), float(alpha), int(it))
                for rank, reg, alpha, it in itertools.product(ranks, regs, alphas, iters)]
    rows, best, best_model = [], None, None
    try:
        with ThreadPool(parallelism) as pool:   # of waiting driver threads: the fits are Spark jobs
            for row, model in pool.imap(inheritable_thread_target(spark)(measured), settings):
                rows.append(row)
                if row["rmse"] is not None and (best is None or row["rmse"] < best["rmse"]):
                    best, best_model = row, model
                model = None
                free_dropped(spark)
        if best is not None and best_model is None:   # its fit was before a restart
            best_model = sized(make_als(best["rank"], best["reg_param"], best["max_iter"], best["alpha"], implicit),
                               n_ratings).fit(train)
    finally:
        kept.unpersist()
    return spark.createDataFrame(rows, GRID_SCHEMA), best_model, best


def fits_at_a_time(n: int) -> int:
    """Settings to fit at a time on ``n`` ratings: a small fit waits for the
    driver most of the time, a large one needs the executors alone."""
    return max(1, min(8, IN_MEMORY // max(n, 1)))


GRID_SCHEMA = ("rank int, reg_param double, alpha double, max_iter int, n bigint, "
               "mse double, rmse double, mae double")


def _setting(row: dict) -> tuple:
    return int(row["rank"]), float(row["reg_param"]), float(row["alpha"]), int(row["max_iter"])


def _finished(spark: SparkSession, results: str) -> list[dict]:
    """The kept rows of an earlier search, if there was one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(results)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return []
    kept = spark.read.schema(GRID_SCHEMA).option("recursiveFileLookup", "true").parquet(results)
    return [r.asDict() for r in kept.collect()]


def save_and_reload(model: ALSModel, path: str) -> ALSModel:
    """Save (overwriting) and load back."""
    model.write().overwrite().save(path)
    return ALSModel.load(path)


def grid_search_tvs(ratings: DataFrame, ranks: Sequence[int] = FULL_GRID["ranks"],
                    regs: Sequence[float] = FULL_GRID["regs"],
                    alphas: Sequence[float] = FULL_GRID["alphas"],
                    iters: Sequence[int] = FULL_GRID["iters"], implicit: bool = True,
                    fraction: float = 0.8, parallelism: int = 2):
    """M3 with ``TrainValidationSplit``: the same grid fitted ``parallelism``
    settings at a time; returns (results DataFrame, best model).

    ``TrainValidationSplit`` splits at random (seeded); ``grid_search`` is
    the deterministic hash-split form.
    """
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
    als = make_als(implicit=implicit)
    grid = (ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.regParam, list(regs))
            .addGrid(als.alpha, list(alphas)).addGrid(als.maxIter, list(iters)).build())
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    tvs = TrainValidationSplit(estimator=als, estimatorParamMaps=grid, evaluator=ev,
                               trainRatio=fraction, parallelism=parallelism, seed=SEED)
    spark = ratings.sparkSession
    ratings = ratings.persist(StorageLevel.DISK_ONLY)
    n = ratings.count()
    tvs.setEstimator(sized(als, n))
    numbers = ratings.select("user_ix", "item_ix", "rating")
    try:
        if n > IN_MEMORY:
            # the library caches its two parts in memory, unless they are cached already
            dealt = numbers.select("*", F.rand(SEED).alias(f"{tvs.uid}_rand"))
            held_out = dealt[f"{tvs.uid}_rand"] >= fraction
            for part in (dealt.filter(~held_out), dealt.filter(held_out)):
                part.persist(StorageLevel.DISK_ONLY)
        model = tvs.fit(numbers)
    finally:
        ratings.unpersist()
    rows = [dict(rank=int(pm[als.rank]), reg_param=float(pm[als.regParam]),
                 alpha=float(pm[als.alpha]), max_iter=int(pm[als.maxIter]), rmse=float(m))
            for pm, m in zip(grid, model.validationMetrics)]
    schema = "rank int, reg_param double, alpha double, max_iter int, rmse double"
    return spark.createDataFrame(rows, schema), model.bestModel


def find_model(spark: SparkSession, ratings: DataFrame, model_path: str,
               ranks: Sequence[int] = FULL_GRID["ranks"], regs: Sequence[float] = FULL_GRID["regs"],
               alphas: Sequence[float] = FULL_GRID["alphas"],
               iters: Sequence[int] = FULL_GRID["iters"], implicit: bool = True, results: str | None = None,
               parallelism: int = 1) -> DataFrame:
    """H7: grid on a hold-out split, the best setting re-scored on the full
    file (the source's "test" evaluation) as well, best model saved.  With
    ``results`` a search that was cut off goes on (see ``grid_search``).

    Returns the grid rows (``evaluated_on='holdout'``) and one row for the
    best model on the full file (``evaluated_on='full_file'``).
    """
    res, best_model, best = grid_search(spark, ratings, ranks, regs, alphas, iters, implicit,
                                        results=results, parallelism=parallelism)
    pred = score_pairs(best_model, ratings.select("user_ix", "item_ix", "rating"))
    full = error_metrics(pred.select(F.col("rating").cast("double").alias("actual"),
                                     F.col("prediction").cast("double").alias("predicted")))
    full = full.select(F.lit(best["rank"]).alias("rank"), F.lit(best["reg_param"]).alias(
        "reg_param"), F.lit(best["alpha"]).alias("alpha"), F.lit(best["max_iter"]).alias(
        "max_iter"), "n", "mse", "rmse", "mae", F.lit("full_file").alias("evaluated_on"))
    save_and_reload(best_model, model_path)
    return res.withColumn("evaluated_on", F.lit("holdout")).unionByName(full)
