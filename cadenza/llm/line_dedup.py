"""Line deduplication by range-partitioned line hashes.

Every line of at least ``min_chars`` code points is keyed by a 128-bit hash
of the line stripped of ASCII white space and with A-Z lower-cased.  The
(hash, document, position) rows are dealt by *range* over the whole triple
and sorted, so a line that fills a third of the corpus spreads over many
tasks; each task streams its sorted rows once and sees the first occurrence
of a key (the largest document id) before the others.  Only the first and
the last key of a task can go on in another task: their rows come out
undecided and meet a table of at most two keys per task.  What goes on to
the documents is a compressed bitmap of kept lines, never text.

Defined cases: a null or empty text is one empty line; a null document id is
one more id, smaller than all others; rows that repeat an id are one document
when counting documents, and each row keeps its own bitmap; other columns of
the input are ignored, whatever their names.  Ids are integers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from cadenza.llm.common import batch, int64, settled, text_bytes, whole_texts

MIN_CHARS = 20
MIN_DOCS = 3

_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                    ("row_key", pa.int64()), ("pos", pa.int32())])
_SEEN = pa.schema([("open", pa.bool_())] + list(_LINES))
_SEEN_DDL = "open boolean, h1 long, h2 long, doc_id long, row_key long, pos int"


def _rows(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, row_key and the text; (id0, row_key) names a row's content."""
    return whole_texts(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col(text)).alias("row_key"),
        text_bytes(text).alias("body"))


def _keyed_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, pos, keys = [], [], []
            for i, body in enumerate(b.column("body").to_pylist()):
                for p, line in enumerate(body.split(b"\n")):
                    key = line.strip().lower()  # bytes: ASCII white space, A-Z
                    n = len(key)
                    if n < min_chars:
                        continue
                    if n < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
                        continue
                    row.append(i)
                    pos.append(p)
                    keys.append(xxhash.xxh3_128_digest(key))
            h = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            at = pa.array(row, type=pa.int32())
            yield batch(_LINES, h[:, 0].copy(), h[:, 1].copy(),
                        b.column("doc_id").take(at), b.column("row_key").take(at), pos)
    return run


def _first_occurrences(min_docs: int):
    """Stream sorted rows; out come rows to drop and undecided (open) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None   # the last key seen, still growing
        first = None                   # the task's first key may begin in another task

        def out(t: pa.Table, still_open: bool) -> pa.RecordBatch:
            t = t.combine_chunks()
            cols = [c.chunk(0) if c.num_chunks else pa.array([], type=c.type) for c in t.columns]
            return batch(_SEEN, np.full(t.num_rows, still_open), *cols)

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b.select(_LINES.names)], schema=None)
            t = t.cast(_LINES)
            if held is not None:
                t = pa.concat_tables([held, t])
            t = t.combine_chunks()
            h1, h2 = int64(t["h1"].chunk(0)), int64(t["h2"].chunk(0))
            if first is None:
                first = (h1[0], h2[0])
            new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            starts = np.flatnonzero(new)
            end = starts[-1]
            held = t.slice(end)
            if not end:
                continue
            done = t.slice(0, end).combine_chunks()
            starts, new, h1, h2 = starts[:-1], new[:end], h1[:end], h2[:end]
            doc, none = int64(done["doc_id"].chunk(0)), done["doc_id"].chunk(0).is_null().to_numpy(False)
            other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (none[1:] != none[:-1])]) | new
            nth = np.cumsum(other)
            run_of = np.cumsum(new) - 1
            docs_in = np.add.reduceat(other.astype(np.int64), starts)
            drop = (docs_in[run_of] >= min_docs) & (nth != nth[starts][run_of])
            opened = (h1 == first[0]) & (h2 == first[1])
            for mask, is_open in ((drop & ~opened, False), (opened, True)):
                if mask.any():
                    yield out(done.filter(pa.array(mask)), is_open)
        if held is not None:
            yield out(held, True)
    return run


def dropped_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """(id0, row_key, pos) of every line to drop; positions count from 0.

    A key in at least ``min_docs`` documents loses all its lines but those of
    the largest document id that holds it.
    """
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "row_key", "pos"]
    lines = (_rows(docs, text).select("doc_id", "row_key", "body")
             .mapInArrow(_keyed_lines(min_chars),
                         "h1 long, h2 long, doc_id long, row_key long, pos int"))
    seen = settled(lines.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_first_occurrences(min_docs), _SEEN_DDL))
    undecided = seen.where("open")
    # at most two keys per task of the pass above, whatever the input
    ends = (undecided.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
            .where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc"))
    late = (undecided.join(F.broadcast(ends), ["h1", "h2"])
            .where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))))
    cols = [F.coalesce("doc_id", F.lit(0)).alias("id0"), "row_key", "pos"]
    return seen.where(~F.col("open")).select(*cols).unionByName(late.select(*cols))


@F.pandas_udf(BinaryType())
def _bitmap(n_lines, dropped):
    import pandas as pd

    def one(n, gone):
        keep = np.ones(int(n), dtype=bool)
        keep[np.asarray(gone, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes(), 1)
    return pd.Series([one(n, g) for n, g in zip(n_lines, dropped)])


def keep_bitmaps(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """id0, row_key, n_lines, n_dropped, keep_bitmap for each distinct row.

    ``keep_bitmap`` is zlib over bits packed from the high end, one per line.
    ``id0`` is the id (0 for null) and ``row_key`` a hash of id and text.
    """
    heads = _rows(docs, text).select(
        "id0", "row_key", F.size(F.split(F.col("body").cast("string"), "\n")).alias("n_lines"))
    gone = dropped_lines(docs, text, min_chars, min_docs)
    both = (heads.select("id0", "row_key", "n_lines", F.lit(None).cast("int").alias("pos"))
            .unionByName(gone.select("id0", "row_key", F.lit(None).cast("int").alias("n_lines"), "pos")))
    return (both.groupBy("id0", "row_key")
            .agg(F.max("n_lines").cast("long").alias("n_lines"), F.collect_set("pos").alias("gone"))
            .select("id0", "row_key", "n_lines", F.size("gone").cast("long").alias("n_dropped"),
                    _bitmap("n_lines", "gone").alias("keep_bitmap")))


def kept_body(body: bytes, n_lines: int, bitmap: bytes) -> bytes:
    """The text without its dropped lines."""
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines)
    return b"\n".join([x for x, k in zip(body.split(b"\n"), keep.tolist()) if k])


def _rewritten(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for body, n, gone, bits in zip(*(b.column(c).to_pylist() for c in
                                             ("body", "n_lines", "n_dropped", "keep_bitmap"))):
                if gone:
                    body = kept_body(body, n, bits)
                made.append(hashlib.sha256(body).hexdigest() if digest else body.decode("utf-8", "replace"))
            kept = [c for c in b.schema.names if c not in ("body", "keep_bitmap")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(made, type=pa.string())], kept + ["made"])
    return run


def _with_bitmaps(docs: DataFrame, text: str, **limits) -> DataFrame:
    marks = keep_bitmaps(docs, text, **limits)
    rows = _rows(docs, text)
    # marks: one small row per document, so a partition of them fits in memory
    return rows.join(marks.hint("shuffle_hash"), ["id0", "row_key"])


def line_digests(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the lines kept) per row."""
    rows = _with_bitmaps(docs, text, **limits).select(
        "doc_id", "n_lines", "n_dropped", "body", "keep_bitmap")
    return (rows.mapInArrow(_rewritten(True), "doc_id long, n_lines long, n_dropped long, made string")
            .withColumnRenamed("made", "kept_sha256"))


def dedup_lines(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents with dropped lines taken out of the text.

    Columns and their order stay; a null text stays null, and ``n_chars``, if
    present, is counted anew where lines went.
    """
    marks = keep_bitmaps(docs, text, **limits)
    own = {c: F.col(c) for c in docs.columns}
    packed = docs.select(
        F.struct(*own.values()).alias("cz_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col(text)).alias("row_key"))
    joined = packed.join(marks.hint("shuffle_hash"), ["id0", "row_key"])
    changed = F.col("n_dropped") > 0
    kept = _kept_text(F.col(f"cz_row.`{text}`").cast("binary"), "n_lines", "n_dropped", "keep_bitmap")
    joined = joined.withColumn(
        "cz_text", F.when(changed, kept).otherwise(F.col(f"cz_row.`{text}`")))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col("cz_text").alias(c))
        elif c == "n_chars":
            out.append(F.when(changed, F.length("cz_text")).otherwise(F.col("cz_row.n_chars"))
                       .cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"cz_row.`{c}`").alias(c))
    return joined.select(*out)


@F.pandas_udf(StringType())
def _kept_text(body, n_lines, n_dropped, bitmap):
    import pandas as pd

    return pd.Series([kept_body(b, n, k).decode("utf-8", "replace") if g and b is not None else None
                      for b, n, g, k in zip(body, n_lines, n_dropped, bitmap)], dtype=object)
