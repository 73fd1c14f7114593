"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are windows of ``window`` consecutive words of a benchmark
item (an item of fewer words, but not none, is one window).  The alphabet of
the search is words: a *shift table* tells for each block of up to three
words how far the search may jump without passing an occurrence, so most
positions are never looked at; where the shift is zero, a bucket found by the
*hash of the suffix block* holds the windows that end so, and a comparison of
all words confirms.  Windows of one length are searched together.

The benchmark is dealt into blocks of at most about ``block_bytes`` of text,
each broadcast by itself and searched in a pass of its own over the documents
(narrow, no shuffle), so no broadcast grows with the benchmark.  A document
of any length is searched whole.

Defined cases: a null text has no words; an item without words has no
windows; an item with a null id hits words and goes by the empty string;
rows that repeat an item id are one item, rows that repeat a document id stay
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import settled, text_bytes, whole_texts

WINDOW = 10
BLOCK_BYTES = 1 << 20

# A-Z to a-z, a-z, 0-9 and all bytes of non-ASCII characters stay; the rest parts words.
_WORD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
              else 0x20 for c in range(256))


def words(body: bytes) -> list[bytes]:
    """The words of a text, lower-cased in A-Z."""
    return body.translate(_WORD).split()


class _Length:
    """Shift table and suffix buckets of all windows of one length."""

    def __init__(self, size: int):
        self.size = size
        self.block = min(3, size)
        self.jump = size - self.block + 1
        self.windows: dict[tuple, list[int]] = {}
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict[tuple, list[int]]] = {}

    def add(self, window: tuple, item: int) -> None:
        items = self.windows.setdefault(window, [])
        if not items or items[-1] != item:
            items.append(item)

    def build(self) -> _Length:
        m, b = self.size, self.block
        for window, items in self.windows.items():
            for end in range(b, m + 1):
                key = window[end - b:end]
                if self.shift.get(key, self.jump) > m - end:
                    self.shift[key] = m - end
            self.bucket.setdefault(window[m - b:], {})[window[:m - b]] = items
        return self

    def search(self, ws: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of every occurrence."""
        m, b, jump, n = self.size, self.block, self.jump, len(ws)
        shift, bucket = self.shift.get, self.bucket
        at = m
        while at <= n:
            key = tuple(ws[at - b:at])
            step = shift(key, jump)
            if step:
                at += step
                continue
            items = bucket[key].get(tuple(ws[at - m:at - b]))
            if items is not None:
                yield at - m, items
            at += 1


def _tables(items: list[tuple[str, bytes]], window: int) -> list[_Length]:
    by: dict[int, _Length] = {}
    for k, (_, body) in enumerate(items):
        ws = words(body)
        if not ws:
            continue
        m = min(window, len(ws))
        table = by.setdefault(m, _Length(m))
        for s in range(len(ws) - m + 1):
            table.add(tuple(ws[s:s + m]), k)
    return [by[m].build() for m in sorted(by)]


_built: dict[str, tuple[list[str], list[_Length]]] = {}


def _block_tables(name: str, block, window: int) -> tuple[list[str], list[_Length]]:
    """The tables of a block; a worker keeps those of one block at a time."""
    if name not in _built:
        _built.clear()
        items = block.value
        _built[name] = [i for i, _ in items], _tables(items, window)
    return _built[name]


def _search_pass(name: str, block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tables = _block_tables(name, block, window)
            spans, items = b.column("spans").to_pylist(), b.column("items").to_pylist()
            for r, body in enumerate(b.column("body").to_pylist()):
                ws = words(body)
                for t in tables:
                    for start, found in t.search(ws):
                        if spans[r] and spans[r][-2] <= start <= spans[r][-1] <= start + t.size:
                            spans[r][-1] = start + t.size
                        else:
                            spans[r] += [start, start + t.size]
                        items[r].extend(ids[k] for k in found)
                items[r] = sorted(set(items[r]))
            cols = [pa.array(spans, type=pa.list_(pa.int64())) if c == "spans"
                    else pa.array(items, type=pa.list_(pa.string())) if c == "items"
                    else b.column(c) for c in b.schema.names]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)
    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's distinct (item, body) in blocks of about ``block_bytes``."""
    bench = settled(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                                     text_bytes("text").alias("body")).distinct())
    total = bench.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for k in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k)
        yield [(r.item, bytes(r.body)) for r in part.collect()]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                   window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, body, spans, items for every row of the documents.

    ``spans`` is a flat list start, end, start, end, ... of word positions
    covered by occurrences (they may overlap); ``items`` the ids found, sorted
    as strings.
    """
    spark = docs.sparkSession
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(text).alias("body"),
                       F.array().cast("array<long>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    ddl = "doc_id long, body binary, spans array<long>, items array<string>"
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_search_pass(uuid.uuid4().hex, shared, window), ddl)
    return rows


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_words, n_hit, n_items, digest = [], [], [], []
        for body, spans, items in zip(*(b.column(c).to_pylist() for c in ("body", "spans", "items"))):
            n = len(words(body))
            hit = np.zeros(n + 1, dtype=np.int64)
            if spans:
                ends = np.asarray(spans, dtype=np.int64).reshape(-1, 2)
                np.add.at(hit, ends[:, 0], 1)
                np.add.at(hit, ends[:, 1], -1)
            n_words.append(n)
            n_hit.append(int((np.cumsum(hit) > 0).sum()))
            n_items.append(len(items))
            digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array(n_items, pa.int64()), pa.array(digest, pa.string()),
             pa.array([h > 0 for h in n_hit], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                         **search) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row."""
    return benchmark_hits(docs, benchmark, text, **search).mapInArrow(
        _reported, "doc_id long, n_words long, n_hit long, n_items long, "
                   "items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs; columns stay."""
    spark = docs.sparkSession
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        docs = whole_texts(docs).where(~_occurs(uuid.uuid4().hex, shared, window)(text_bytes(text)))
    return docs


def _occurs(name: str, shared, window: int):
    @F.pandas_udf("boolean")
    def occurs(body):
        _, tables = _block_tables(name, shared, window)

        def one(b):
            ws = words(b)
            return any(next(t.search(ws), None) is not None for t in tables)
        return body.map(one)
    return occurs
