"""Structured Streaming form of the triplet ingest (S2 -> S9).

The source converts one tab-separated triplet file to Parquet in a batch
job.  Play logs arrive as files over time, so the same conversion also runs
as a file-source stream: new files in the landing folder are parsed with the
typed reader's rules (``try_cast``; bad rows to a reject sink) and appended
to Parquet.  Progress lives in a checkpoint under the shared checkpoint
folder, so a restarted job (or a lost executor) resumes without duplicates.
``trigger(availableNow=True)`` processes everything present and stops, which
is also how the tests drive it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLET_TEXT_SCHEMA = "user_id string, song_id string, play_count string"


def parse_triplets(raw: DataFrame) -> DataFrame:
    """Typed rows plus a ``_bad`` flag (NULL id or non-integer count)."""
    cnt = F.expr("try_cast(play_count AS INT)")
    bad = F.col("user_id").isNull() | F.col("song_id").isNull() | cnt.isNull()
    return raw.select("user_id", "song_id", cnt.alias("play_count"), bad.alias("_bad"))


def start_triplet_stream(spark: SparkSession, landing: str, out: str, rejects: str,
                         checkpoint: str, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    raw = (spark.readStream.schema(TRIPLET_TEXT_SCHEMA).option("sep", "\t")
           .option("maxFilesPerTrigger", 64).csv(landing))
    parsed = parse_triplets(raw)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch overwrites its own folder, so the sink is
        # idempotent (exactly-once together with the checkpointed offsets).
        batch.persist()
        batch.where(~F.col("_bad")).drop("_bad").write.mode("overwrite") \
            .parquet(f"{out}/batch_id={batch_id}")
        batch.where(F.col("_bad")).drop("_bad").write.mode("overwrite") \
            .parquet(f"{rejects}/batch_id={batch_id}")
        batch.unpersist()

    w = parsed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
