"""Feature expressions: genre labels, clamping, content vectors, score classes.

All of these are built-in column expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The ten genre names and their class ids, in class-id order.
# These must equal the source data's labelling for results to match.
GENRE_CLASSES = [
    ("folk", 0),
    ("jazz and blues", 1),
    ("classic pop and rock", 2),
    ("classical", 3),
    ("punk", 4),
    ("metal", 5),
    ("pop", 6),
    ("dance and electronica", 7),
    ("hip-hop", 8),
    ("soul and reggae", 9),
]
# The column layout of the genre text file (34 columns).
GENRE_SCALARS = ["loudness", "tempo", "time_signature", "key", "mode", "duration"]
GENRE_TIMBRE_AVG = [f"avg_timbre{i}" for i in range(1, 13)]
GENRE_TIMBRE_VAR = [f"var_timbre{i}" for i in range(1, 13)]
GENRE_FILE_COLUMNS = (["genre", "track_id", "artist_name", "title"]
                      + GENRE_SCALARS + GENRE_TIMBRE_AVG + GENRE_TIMBRE_VAR)
GENRE_FEATURES_30 = GENRE_SCALARS + GENRE_TIMBRE_AVG + GENRE_TIMBRE_VAR
# The six content attributes of a song, in vector order.
CONTENT_ATTRIBUTES = ["danceability", "energy", "key", "loudness", "tempo", "time_signature"]
# ---------------------------------------------------------------------------


def genre_name_to_id(col: Column | str) -> Column:
    """Genre name -> class id through a literal map; unknown -> NULL."""
    pairs = []
    for name, gid in GENRE_CLASSES:
        pairs += [F.lit(name), F.lit(gid)]
    m = F.create_map(*pairs)
    return F.element_at(m, F.col(col) if isinstance(col, str) else col)


def genre_id_to_name(col: Column | str) -> Column:
    pairs = []
    for name, gid in GENRE_CLASSES:
        pairs += [F.lit(gid), F.lit(name)]
    m = F.create_map(*pairs)
    return F.element_at(m, F.col(col) if isinstance(col, str) else col)


def clamp_nonneg(col: Column | str) -> Column:
    """Negatives fold to zero (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c < 0, F.lit(0.0)).otherwise(c.cast("double"))


def content_vector_columns() -> list[Column]:
    """The six content features; danceability and energy scaled by 10."""
    return [
        (F.col("danceability") * 10).alias("f_dance"),
        (F.col("energy") * 10).alias("f_energy"),
        F.col("key").cast("double").alias("f_key"),
        F.col("loudness").cast("double").alias("f_loudness"),
        F.col("tempo").cast("double").alias("f_tempo"),
        F.col("time_signature").cast("double").alias("f_time_sig"),
    ]


CONTENT_FEATURE_NAMES = ["f_dance", "f_energy", "f_key", "f_loudness", "f_tempo", "f_time_sig"]


def score_class(col: Column | str) -> Column:
    """Score -> class label by truncation toward zero (0.99 -> 0, 9.99 -> 9)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("int")
