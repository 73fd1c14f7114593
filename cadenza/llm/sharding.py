"""Sharding by a two-pass external shuffle, with DataFrame operations only.

Pass one scatters the records, whole rows, uniformly into buckets by a seeded
hash: one shuffle, in which a bucket is one partition of about
``bucket_bytes``, small enough for a task's memory.  Pass two takes each
bucket by itself: its records are put in a fixed order and then in a random
one by Spark's ``shuffle`` of an array, which is the Fisher-Yates shuffle,
seeded by the given seed and the bucket's number.  A uniform
scatter followed by a uniform permutation of each bucket is a uniform
permutation of all records, and no task ever holds more than a bucket.

The buckets in turn are the order of all records; the shards are its
consecutive stretches.  The law that holds is ``rows``: the shards' counts are
at most one apart.  A bucket lies in one shard or in neighbouring ones, so
``write_shards`` needs no further shuffle and each file is a gapless run of
slots.  What the driver learns is the number of rows and bytes; the offsets of
buckets are a table of one row a bucket.

The hash covers id, text and the input partition that holds a row, so an id,
or one text with one id, that fills a third of the table is spread too: at
most an input partition of equal rows meets in a bucket.  Both reads of the
scattered records are one exchange, and a partition that is computed again
after the loss of an executor gets the same records: the number of an input
partition does not change, their order inside does not matter.

Defined cases: a null text has no bytes; a null id is one more id; rows that
repeat are records of their own; fewer records than shards leave the last
shards empty; an empty table gives no rows; other columns, whatever their
names, travel with their record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHARDS = 24
SEED = 42
BUCKET_BYTES = 64 << 20
ROW_BYTES = 8   # of a record besides its text


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text, and eight."""
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + ROW_BYTES).cast("long")


def scattered(docs: DataFrame, buckets: int, seed: int = SEED, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """Pass one: (bucket, tie, record); bucket k is partition k."""
    tie = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    rows = docs.select(tie.alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                       F.spark_partition_id().alias("part"))
    rows = rows.select(F.pmod(F.xxhash64(F.lit(~seed), "tie", "part"), F.lit(buckets)).cast("int").alias("bucket"),
                       "tie", "record")
    return rows.repartitionById(buckets, "bucket")


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows with ``shard`` (int) and ``slot`` (long, gapless from 0)."""
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(record_size(text)), F.lit(0))).first()
    buckets = max(shards, -(-total // bucket_bytes))
    dealt = scattered(docs, buckets, seed, text, doc_id)
    # counted over whole records, so that both reads share one exchange
    held = (dealt.groupBy("bucket").agg(F.count("*").alias("held"), F.max(F.xxhash64("tie", "record")).alias("seen"))
            .where(F.col("seen").isNotNull()))
    before = F.coalesce(F.sum("held").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias("before")
    offsets = held.select("bucket", before)   # one row a bucket: bytes / bucket_bytes rows
    # a bucket's array: in one order however it arrived, then Fisher-Yates
    items = F.shuffle(F.sort_array(F.collect_list(F.struct("tie", "record"))), F.lit(seed))
    placed = (dealt.groupBy("bucket").agg(items.alias("items"))
              .select("bucket", F.posexplode("items").alias("nth", "item"))
              .join(F.broadcast(offsets), "bucket")
              .select((F.col("before") + F.col("nth")).alias("place"), F.col("item.record").alias("record")))
    shard, slot = _stretch(F.col("place"), rows, shards)
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*[F.col(f"record.`{c}`").alias(c) for c in own],
                         shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def _stretch(place: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place among ``rows``: the first shards take one
    row more where the rows do not come out even."""
    least, more = divmod(rows, shards)
    long_end = more * (least + 1)
    first = place < long_end
    rest, each = place - long_end, max(least, 1)
    shard = F.when(first, F.floor(place / (least + 1))).otherwise(more + F.floor(rest / each))
    return shard, F.when(first, place % (least + 1)).otherwise(rest % each)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards as Parquet folders ``shard=K`` under ``path``, each
    file a run of slots in order."""
    shuffled_shards(docs, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def placements(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    dealt = shuffled_shards(docs.select("doc_id", "text"), shards, **options)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return dealt.select("doc_id", record_size().alias("size"), F.crc32(body).alias("text_crc32"),
                        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
