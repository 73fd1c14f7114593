"""H9: the ingest jobs as one plan.

Source files (triplets TSV, songs and attributes CSV, packed similarity CSV)
are read with the typed readers; good rows become Parquet tables, bad rows
go to per-input reject tables.  The similarity lists are unpacked to long
form at ingest, so every later job joins on (tid, target) directly.  The
song -> hash dimension is built from the songs table and de-duplicated at
build time.  Tables are written with the source's default mode (fail if the
path exists).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.packed import unpack_pairs
from cadenza.operators.ids import hash_dimension
from cadenza.sources import readers


def ingest(spark: SparkSession, triplets: str, songs_csv: str, attributes_csv: str,
           similar_csv: str, out: str) -> DataFrame:
    """Write ``songs_data``, ``triplets_data``, ``song_similarity``,
    ``song_hash_id`` and ``*_rejects`` under ``out``; return a summary
    (table, n_rows) read back from the written tables."""
    plays, bad_plays = readers.read_triplets(spark, triplets, "tab_int")
    songs, bad_songs = readers.read_songs_csv(spark, songs_csv)
    attrs, bad_attrs = readers.read_attributes_csv(spark, attributes_csv)
    packed, bad_sim = readers.read_similar_csv(spark, similar_csv)
    sim = unpack_pairs(packed)

    tables = {
        "triplets_data": plays,
        "songs_data": songs.join(attrs, "track_id"),
        "song_similarity": sim,
        "song_hash_id": hash_dimension(songs),
        "triplets_rejects": bad_plays,
        "songs_rejects": bad_songs,
        "attributes_rejects": bad_attrs,
        "similarity_rejects": bad_sim,
    }
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{out}/{name}")
    summary = None
    for name in tables:
        c = spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit(name).alias("table"), "n_rows")
        summary = c if summary is None else summary.unionByName(c)
    return summary
