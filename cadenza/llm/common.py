"""Small helpers shared by the text operators."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadenza.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, opened through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null reads as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def whole_texts(df: DataFrame) -> DataFrame:
    """The same rows; where the session leaves it open, Python workers get
    1,000 rows at a time, not 10,000, as each holds a whole text."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, "1000")
    return df


def settled(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder and cut the lineage.

    The files are removed by Spark's cleaner once nothing refers to them
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let go of the files of finished steps now: Spark removes shuffle and
    checkpoint files when the driver's collector finds nothing refers to them,
    which on an idle driver can take until the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no model learns from."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def int64(array: pa.Array, null: int = 0) -> np.ndarray:
    """An Arrow integer array as int64; nulls become ``null``."""
    if array.null_count:
        array = array.fill_null(null)
    return array.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of the given columns, cast to the schema."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type
         else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema)], schema=schema)
