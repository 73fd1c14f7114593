"""Typed text readers (S1-S7) with reject tables.

The source parses text with Python ``split`` lambdas: a comma inside a quoted
title shifts every column, a bad number aborts the job, and header removal
also drops data lines that happen to contain ``track_id``.  Here the CSV
reader handles quoting and the header; every value is read as text and
converted with ``try_cast``, so a bad value sends its row to a reject table
(with a reason) instead of failing the job.  Each reader returns
``(rows, rejects)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.features import GENRE_FILE_COLUMNS, genre_name_to_id
from cadenza.functions.packed import dangling_count, packed_entries, unpack_pairs

# The typed column layouts of the source files.
SONG_COLUMNS = [
    ("track_id", "string"), ("title", "string"), ("song_id", "string"),
    ("release", "string"), ("artist_id", "string"), ("artist_mbid", "string"),
    ("artist_name", "string"), ("duration", "double"), ("artist_familiarity", "double"),
    ("artist_hotttnesss", "double"), ("year", "int"), ("track_7digitalid", "int"),
    ("shs_perf", "int"), ("shs_work", "int"),
]
ATTRIBUTE_COLUMNS = [
    ("track_id", "string"), ("danceability", "double"), ("energy", "double"),
    ("key", "int"), ("loudness", "double"), ("tempo", "double"), ("time_signature", "int"),
]


def _typed(cols: list[tuple[str, str]]) -> tuple[list[Column], Column]:
    """try_cast every column; a row is bad when a present value fails."""
    out, bad = [], F.lit(False)
    for name, typ in cols:
        raw = F.col(name)
        if typ == "string":
            out.append(raw.alias(name))
            continue
        v = F.expr(f"try_cast(`{name}` AS {typ})")
        out.append(v.alias(name))
        bad = bad | (raw.isNotNull() & (F.trim(raw) != "") & v.isNull())
    return out, bad


def _split_rejects(df: DataFrame, cols: list[Column], bad: Column, reason: str):
    flagged = df.withColumn("_bad", F.coalesce(bad | F.col(CORRUPT).isNotNull(), F.lit(True)))
    rows = flagged.where(~F.col("_bad")).select(*cols)
    rejects = flagged.where(F.col("_bad")).select(
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw"),
        F.lit(reason).alias("reason"))
    return rows, rejects


CORRUPT = "_corrupt"   # the whole line, where it has too many or too few fields


def _csv_text(spark: SparkSession, path: str, names: list[str], header: bool, **opts):
    """All columns as text, and ``CORRUPT``.  With a header, columns are taken
    by the header's names, wherever they stand; names that the file lacks are
    null.  Doubled quotes inside quoted values are one quote."""
    if header:
        found = (spark.read.option("header", "true").option("inferSchema", "false")
                 .option("escape", '"').options(**opts).csv(path).columns)
    else:
        found = names
    schema = ", ".join(f"`{n}` string" for n in found) + f", `{CORRUPT}` string"
    r = (spark.read.schema(schema).option("header", str(header).lower())
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("escape", '"').option("enforceSchema", "false").options(**opts))
    df = r.csv(path)
    return df.select(*[F.col(f"`{n}`") if n in found else F.lit(None).cast("string").alias(n)
                       for n in names], CORRUPT)


def read_triplets(spark: SparkSession, path: str, variant: str = "tab_int"):
    """User \\t song \\t count, no header.

    Variants of the source: ``tab_int`` (ingest job), ``tab_float`` (model
    finder), ``whitespace_float`` (split on any whitespace).
    """
    if variant in ("tab_int", "tab_float"):
        df = _csv_text(spark, path, ["user_id", "song_id", "play_count"], False, sep="\t")
    elif variant == "whitespace_float":
        parts = F.split(F.trim(F.col("value")), r"\s+")
        df = spark.read.text(path).select(
            F.get(parts, 0).alias("user_id"), F.get(parts, 1).alias("song_id"),
            F.get(parts, 2).alias("play_count"),
            F.when(F.size(parts) != 3, F.col("value")).alias(CORRUPT))
    else:
        raise ValueError(variant)
    typ = "int" if variant == "tab_int" else "double"
    cols, bad = _typed([("user_id", "string"), ("song_id", "string"), ("play_count", typ)])
    bad = bad | F.col("user_id").isNull() | F.col("song_id").isNull() \
        | F.col("play_count").isNull()
    return _split_rejects(df, cols, bad, "bad triplet")


def read_songs_csv(spark: SparkSession, path: str):
    """S3 + S5 + P14: the 14-column songs metadata CSV with a header line."""
    names = [n for n, _ in SONG_COLUMNS]
    df = _csv_text(spark, path, names, True)
    cols, bad = _typed(SONG_COLUMNS)
    return _split_rejects(df, cols, bad | F.col("track_id").isNull(), "bad song row")


def read_attributes_csv(spark: SparkSession, path: str):
    """The 7-column attributes CSV with a header line."""
    names = [n for n, _ in ATTRIBUTE_COLUMNS]
    df = _csv_text(spark, path, names, True)
    cols, bad = _typed(ATTRIBUTE_COLUMNS)
    return _split_rejects(df, cols, bad | F.col("track_id").isNull(), "bad attribute row")


def _similar_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, tid, target, bad): each line split at its first comma, quoted
    or not, quotes trimmed; the header is the line ``tid,target``."""
    lines = spark.read.text(path).where(
        (F.trim("value") != "") & ~F.regexp_replace("value", r'[\s"]', "").eqNullSafe("tid,target"))
    at = F.instr("value", ",")
    quotes = "trim(BOTH '\"' FROM trim({}))"
    rows = lines.select("value", at.alias("_at"),
                        F.when(at > 0, F.substring("value", F.lit(1), at - 1)).alias("_tid"),
                        F.when(at > 0, F.substring("value", at + 1, F.length("value"))).alias("_target"))
    rows = rows.select("value", F.expr(quotes.format("_tid")).alias("tid"),
                       F.expr(quotes.format("_target")).alias("target"))
    scores = packed_entries("target")
    bad_score = F.exists(scores, lambda e: e["score"].isNull() | (e["target"] == ""))
    return rows.select("*", (F.coalesce("tid", F.lit("")) == "").alias("no_id"),
                       F.coalesce(bad_score, F.lit(False)).alias("bad_score"),
                       ((F.coalesce("target", F.lit("")) != "") & (dangling_count("target") == 1)).alias("odd"))


def read_similar_csv(spark: SparkSession, path: str):
    """S6 + P13: (tid, target) with target a packed list.  A line is a row
    unless it has no id or an unreadable score; an odd trailing id is kept in
    the packed list and reported as well, as ``odd tail``."""
    rows = _similar_lines(spark, path)
    unreadable = F.col("no_id") | F.col("bad_score")
    rejects = rows.where(unreadable | F.col("odd")).select(
        F.col("value").alias("raw"),
        F.when(F.col("no_id"), "no id").when(F.col("bad_score"), "bad score").otherwise("odd tail").alias("reason"))
    return rows.where(~unreadable).select("tid", "target"), rejects


def read_similar_long(spark: SparkSession, path: str) -> DataFrame:
    """S6 -> P15: the packed CSV straight to long form (tid, target, score)."""
    return unpack_pairs(read_similar_csv(spark, path)[0])


def read_genre_file(spark: SparkSession, path: str):
    """S7 + P16: the 34-column genre text file.  ``#`` lines are comments,
    the single ``%`` line names the columns; unknown genres and bad numbers
    go to the reject table."""
    df = _csv_text(spark, path, GENRE_FILE_COLUMNS, False, comment="#")
    df = df.where(~F.coalesce(F.col("genre").startswith("%"), F.lit(False)))
    typed = [("genre", "string"), ("track_id", "string"), ("artist_name", "string"),
             ("title", "string")] + [(c, "double") for c in GENRE_FILE_COLUMNS[4:]]
    cols, bad = _typed(typed)
    bad = bad | genre_name_to_id(F.col("genre")).isNull()
    rows, rejects = _split_rejects(df, cols, bad, "bad genre row")
    return rows.withColumn("label", genre_name_to_id("genre")), rejects
