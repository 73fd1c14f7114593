"""Recommender inputs derived from the driver tables.

The reference reads five datasets (play-count triplets, song metadata, audio
attributes, packed item-similarity lists, a genre file).  Here each one is a
Spark plan over the driver tables, so its work grows with them:

* ``plays``        orders x lineitem, one row per (customer, part), value =
                   number of lines (or summed quantity).
* ``songs``        the part catalogue as song metadata.
* ``attributes``   audio-style attributes from ``embeddings``.
* ``similar``      item-item similarity in long form (tid, target, score):
                   parts on *adjacent lines* of the global line order, within
                   one order.  Adjacency is a 1:1 join on a unique position,
                   so no group ever emits all of its pairs and a hot order
                   costs no more than its own line count.
* ``similar_packed`` the same table in the source's packed text layout.
* ``genre``        labelled 30-dim feature rows from ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.features import GENRE_FEATURES_30, genre_id_to_name
from cadenza.operators.ids import global_positions
from cadenza.sources.tables import read

# Fixed derivation parameters.
YEAR_BASE = 1970             # year = 1970 + p_size
LINES_A_TASK = 500_000       # whose plays, with their songs, a task sorts


def plays(spark: SparkSession, sf_dir: str, measure: str = "count") -> DataFrame:
    """Play-count triplets (user_id, song_id, play_count).

    ``measure='count'`` counts lines per (customer, part) as a bigint;
    ``measure='quantity'`` sums ``l_quantity`` (a wider spread, as double).
    The aggregate runs partial-then-final, so a hot customer is combined
    map-side before the shuffle.  Where the session's shuffle partitions would
    be too large for a task, lines and orders meet in more of them.
    """
    li = read(spark, sf_dir, "lineitem")
    od = read(spark, sf_dir, "orders")
    tasks = play_tasks(spark, sf_dir)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        li, od = li.repartition(tasks, "l_orderkey"), od.repartition(tasks, "o_orderkey")
    return count_plays(li.join(od, li.l_orderkey == od.o_orderkey), measure)


def count_plays(j: DataFrame, measure: str = "count") -> DataFrame:
    """The triplets of lines that are joined with their orders.  The keys travel
    as numbers and become ids after the aggregate."""
    if measure == "count":
        value = F.count(F.lit(1)).cast("bigint")
    elif measure == "quantity":
        value = F.sum("l_quantity").cast("double")
    else:
        raise ValueError(measure)
    return (j.groupBy("o_custkey", "l_partkey").agg(value.alias("play_count"))
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("l_partkey").cast("string").alias("song_id"), "play_count"))


def play_tasks(spark: SparkSession, sf_dir: str) -> int:
    """The number of tasks for all plays with their songs: it follows the lines
    (counted from the files' footers), of which plays are at most as many."""
    lines = read(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // LINES_A_TASK))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song metadata (track_id, song_id, title, artist_name, release, duration, year)."""
    p = read(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return p.select(
        key.alias("track_id"),
        key.alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("release"),
        F.col("p_retailprice").cast("double").alias("duration"),
        (F.lit(YEAR_BASE) + F.col("p_size")).cast("int").alias("year"),
    )


def _elem(i: int):
    return F.element_at("embedding", i).cast("double")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio attributes per track (track_id, danceability, energy, key,
    loudness, tempo, time_signature).

    A track's vector is the one whose (dense) ``vec_id`` equals the track key
    modulo the number of vectors, so all vectors are used at any size.
    """
    p = read(spark, sf_dir, "part").select("p_partkey")
    e = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = e.count()   # from the files' footers
    j = p.join(e, (p.p_partkey % F.lit(n)) == e.vec_id)
    return j.select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.abs(_elem(1)).alias("danceability"),
        F.abs(_elem(2)).alias("energy"),
        (F.floor(F.abs(_elem(3)) * 100).cast("int") % 12).alias("key"),
        (_elem(4) * 60).alias("loudness"),
        (F.lit(60.0) + F.abs(_elem(5)) * 200).alias("tempo"),
        (F.lit(3) + F.floor(F.abs(_elem(6)) * 10).cast("int") % 3).alias("time_signature"),
    )


def songs_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs joined with their attributes on track_id (one key column)."""
    return songs(spark, sf_dir).join(attributes(spark, sf_dir), "track_id")


def adjacent_pairs(spark: SparkSession, sf_dir: str, among: DataFrame | None = None) -> DataFrame:
    """(a, b) part pairs of consecutive lines of one order, a != b.

    Lines get a dense global position in (order, line number, part,
    supplier) order; a range-partitioned sort spreads even one hot order
    over many tasks.  The pair join is on the unique position, so every
    line meets exactly one successor.  ``among`` (user_id, song_id) leaves
    only the lines of those plays.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = read(spark, sf_dir, "lineitem").select(*keys)
    if among is not None:
        od = read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("user_id"))
        li = (li.join(od, "l_orderkey").withColumn("song_id", F.col("l_partkey").cast("string"))
              .join(among, ["user_id", "song_id"], "left_semi").select(*keys))
    seq = global_positions(li, keys).select("l_orderkey", "l_partkey", "pos")
    a = seq.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("a"),
                   (F.col("pos") + 1).alias("nxt"))
    b = seq.select(F.col("l_orderkey").alias("o2"), F.col("l_partkey").alias("b"),
                   F.col("pos").alias("p2"))
    return (a.join(b, (a.nxt == b.p2) & (a.o == b.o2))
            .where(F.col("a") != F.col("b")).select("a", "b"))


def similar(spark: SparkSession, sf_dir: str, among: DataFrame | None = None) -> DataFrame:
    """Item similarity in long form: (tid, target, score).

    score = number of adjacent-line occurrences of the pair, both directions;
    ``among`` restricts the lines to those of given plays.
    """
    # one join, whose pairs are turned round as they leave it
    both = adjacent_pairs(spark, sf_dir, among).select(F.inline(F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    return (both.groupBy(F.col("a").cast("string").alias("tid"),
                         F.col("b").cast("string").alias("target"))
            .agg(F.count(F.lit(1)).cast("double").alias("score")))


def similar_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity table in the source layout: (tid, target) with target a
    packed ``"id,score,id,score,..."`` string, entries ordered by id.

    Pairs are aggregated first, so a list holds one entry per distinct
    partner: its length is bounded by the catalogue size, not by plays.
    """
    sim = similar(spark, sf_dir)
    entry = F.struct("target", "score")
    return (sim.groupBy("tid")
            .agg(F.array_sort(F.collect_list(entry)).alias("lst"))
            .select("tid", F.array_join(
                F.transform("lst", lambda s: F.concat_ws(
                    ",", s["target"], s["score"].cast("bigint").cast("string"))),
                ",").alias("target")))


def genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled genre rows: (genre, track_id, artist_name, title, f array<double>[30])."""
    p = read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"), "p_name", "p_brand")
    j = genre_features(spark, sf_dir).join(p, "track_id", "left")
    return j.select(
        "genre", "track_id",
        F.coalesce(F.col("p_brand"), F.lit("unknown")).alias("artist_name"),
        F.coalesce(F.col("p_name"), F.lit("unknown")).alias("title"), "f")


def genre_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the models read: (genre, track_id, f array<double>[30]), from
    ``embeddings`` alone.  The file layout has 30 numbers a row (34 columns
    with the four texts), so these are the vector's first 30."""
    return read(spark, sf_dir, "embeddings").select(
        genre_id_to_name("label").alias("genre"),
        F.col("vec_id").cast("string").alias("track_id"),
        F.slice(F.transform("embedding", lambda x: x.cast("double")), 1,
                len(GENRE_FEATURES_30)).alias("f"))


def genre_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genre rows with the 30 features as named columns (file layout)."""
    g = genre(spark, sf_dir)
    return g.select("genre", "track_id", "artist_name", "title",
                    *[F.element_at("f", i + 1).alias(n)
                      for i, n in enumerate(GENRE_FEATURES_30)])
