"""Sharding and fill-in-the-middle: brute force, invariants and edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import fill_in_middle as fim
from cadenza.llm import sharding

DDL = ("doc_id long, text string, bucket int, record string, tie long, n string, form string, "
       "fim_text string, place long, items array<int>")


def frame(spark, rows):
    """Documents with columns that bear the operators' inner names."""
    return spark.createDataFrame([(i, t, 3, "r", 4, "n", "f", "x", 5, [1]) for i, t in rows], DDL)


TEXTS = [None, "", " ", "\n\t ", "one", " one", "one ", "one two  three\n\nfour ", "a <P> marked text", "<S>", "x<M>y",
         "ends with <P", "< P > is none", "$1 \\2 {3}+ (?s)", " no-break em\x85nel\x1cfs", "😀 𝒳𝒴 é ñ 中文 字",
         "word " * 50_000, "x" * 300_000, " " * 100_000, "a\x00b c", "\r\n".join("line of text" for _ in range(3000))]


def middle_brute(doc_id, text):
    """By the definition, with lists and Python's hash library."""
    t = text or ""
    unit = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h1 % (len(unit) + 1), h2 % (len(unit) + 1)))
    p, m, s = "".join(unit[:a]), "".join(unit[a:b]), "".join(unit[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(unit), "plain", t, None
    if h4 % 100 < 80:
        return doc_id, len(unit), "spm", f"<S>{s}<P>{p}<M>{m}", (p, m, s)
    return doc_id, len(unit), "psm", f"<P>{p}<S>{s}<M>{m}", (p, m, s)


def test_middles_equal_brute_force(spark):
    rows = [(100 * k + j, t) for k, t in enumerate(TEXTS) for j in range(6)] + [(None, "no id here"), (7, "twice"), (7, "twice")]
    got = fim.with_parts(fim.fill_in_middle(frame(spark, rows))).collect()
    want = [middle_brute(i, t) for i, t in rows]
    key = lambda x: (str(x[0]), x[3])
    assert sorted([(r.doc_id, r.n, r.form, r.output, r.parts and tuple(r.parts)) for r in got], key=key) == sorted(want, key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert "bucket" in got[0].asDict() and got[0].fim_text == "x"


def test_middles_are_rebuilt_exactly(spark):
    rows = [(1000 + 50 * k + j, t) for k, t in enumerate(TEXTS) for j in range(4)]
    for r in fim.digests(frame(spark, rows)).collect():
        _, n, form, output, parts = middle_brute(r.doc_id, dict(rows)[r.doc_id])
        assert (r.n, r.form) == (n, form)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((dict(rows)[r.doc_id] or "").encode()).hexdigest()
        assert (r.prefix_chars, r.middle_chars) == ((len(parts[0]), len(parts[1])) if parts else (None, None))


def test_middles_of_an_empty_table(spark):
    assert fim.digests(frame(spark, [])).count() == 0


def test_rates(spark):
    rows = [(k, "some words to cut") for k in range(200)]
    assert {r.form for r in fim.fill_in_middle(frame(spark, rows), fim_rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.fill_in_middle(frame(spark, rows), fim_rate=100, spm_rate=0).collect()} == {"psm"}


def check_shards(rows, got, shards):
    """A permutation of all rows, shards at most one apart, slots gapless."""
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    count = Counter(r.shard for r in got)
    sizes = [count[k] for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert sorted((r.shard, r.slot) for r in got) == [(k, s) for k in range(shards) for s in range(count[k])]


@pytest.mark.parametrize("n, shards", [(0, 24), (1, 24), (23, 24), (24, 24), (1000, 24), (1000, 7)])
def test_shards_hold_every_row_once(spark, n, shards):
    rows = [(k if k % 5 else None, None if k % 11 == 0 else "" if k % 7 == 0 else f"text {k % 13}") for k in range(n)]
    got = sharding.shuffled_shards(frame(spark, rows).repartition(5), shards).collect()
    check_shards(rows, got, shards)
    assert not got or got[0].record == "r" and got[0].items == [1]


def test_rows_that_are_all_equal_are_spread(spark):
    """One id with one text fills the table: no bucket gets most of it."""
    df = spark.range(4000).repartition(40).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    held = [r["count"] for r in sharding.scattered(df, 24).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 4000 and max(held) < 1200 and len(held) >= 12
    check_shards([(1, "same")] * 4000, sharding.shuffled_shards(df, 24).collect(), 24)


def test_buckets_follow_the_bytes(spark):
    df = frame(spark, [(k, "x" * 1000) for k in range(500)])
    plan = sharding.shuffled_shards(df, 4, bucket_bytes=10_000)
    check_shards([(k, "x" * 1000) for k in range(500)], plan.collect(), 4)
    assert "51)" in plan._jdf.queryExecution().toString()   # 504,000 bytes in buckets of 10,000


def test_the_order_is_random_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    order = lambda seed: [r.doc_id for r in sharding.shuffled_shards(df, 8, seed=seed).orderBy("shard", "slot").collect()]
    a, b, c = order(1), order(1), order(2)
    assert a == b and a != c
    for x in (a, c):
        near = sum(abs(p - q) == 1 for p, q in zip(x, x[1:]))   # 2 expected
        up = sum(p < q for p, q in zip(x, x[1:]))               # 2,500 expected, deviation 20
        assert near < 15 and 2350 < up < 2650


def test_sizes_and_checksums(spark):
    rows = [(1, None), (2, ""), (3, "é😀"), (4, "a" * 200_000)]
    got = {r.doc_id: r for r in sharding.placements(frame(spark, rows)).collect()}
    for i, t in rows:
        body = (t or "").encode()
        assert (got[i]["size"], got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(body) + 8, zlib.crc32(body), "rows", None)


def test_written_shards_are_runs_of_slots(spark, tmp_path):
    rows = [(k, f"text {k}") for k in range(300)]
    sharding.write_shards(frame(spark, rows), str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    check_shards(rows, back.collect(), 5)
    runs = back.groupBy(F.input_file_name()).agg(F.max("slot") - F.min("slot") + 1 - F.count("*")).collect()
    assert all(r[1] == 0 for r in runs)
