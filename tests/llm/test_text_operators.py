"""Brute-force and edge-case tests of the line, search, packing and language operators."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, language_id, line_dedup, packing
from cadenza.llm.registry import default_tokenizer

DDL = ("doc_id long, text string, lang string, source string, n_chars long, "
       "pos int, score double, body string, n_lines string, h string")
LONG_LINE = "A line that many documents share, word for word"


def frame(spark, texts, langs=None, first=1):
    """Documents with extra columns whose names operators use inside."""
    rows = []
    for k, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (first + k, t)
        lang = langs[k] if langs else "en"
        rows.append((i, t, lang, "s", None if t is None else len(t), 7, 0.5, "clash", "x", "y"))
    return spark.createDataFrame(rows, DDL)


CASES = [None, "", "\n\n", f"{LONG_LINE}\nown words of the first\n{LONG_LINE}", f"  {LONG_LINE.upper()} \t\nshort",
         f"{LONG_LINE}", "short\nshort", "É" * 19 + "\n" + "É" * 20, "É" * 20, "é" * 20 + "\n" + "É" * 20,
         "É" * 20 + "\r", (5, "the same id again\n" + LONG_LINE), (5, "the same id again\n" + LONG_LINE),
         (None, f"no id\n{LONG_LINE}"), "x" * 200_000 + "\n" + LONG_LINE, "a\n" * 5000 + LONG_LINE]


def lines_brute(rows):
    """(doc_id, text) -> kept text, by the definition."""
    docs = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                docs[key(x)].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        keep = [x for x in (t or "").split("\n")
                if not (len(docs.get(key(x), ())) >= 3 and max(docs[key(x)]) != (-1 if i is None else i))]
        out.append((i, len((t or "").split("\n")), len((t or "").split("\n")) - len(keep),
                    hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_digests_equal_brute_force(spark):
    df = frame(spark, CASES)
    got = sorted((tuple(r) for r in line_dedup.line_digests(df).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)
    assert got == lines_brute([(r.doc_id, r.text) for r in df.collect()])


def test_a_line_in_most_rows_is_split_over_tasks(spark):
    """One key over many range partitions: the undecided rows must agree."""
    df = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(LONG_LINE + "\n"), F.format_string("line of document %05d only", "id"),
                 F.lit("\n" + LONG_LINE)).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in line_dedup.line_digests(df.repartition(7)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {i for i, r in got.items() if r.n_dropped == 0} == {599}
    assert all(r.n_dropped == 2 for i, r in got.items() if i != 599)


def test_dedup_lines_keeps_columns_and_rewrites_text(spark):
    df = frame(spark, CASES)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    rows = out.collect()
    assert len(rows) == len(CASES)
    shas = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows if r.doc_id)
    assert shas == sorted((i, s) for i, _, _, s in lines_brute([(r.doc_id, r.text) for r in df.collect()]) if i)
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert {r.body for r in rows} == {"clash"}


def test_keep_bitmaps_round_trip(spark):
    df = frame(spark, CASES)
    for r in line_dedup.keep_bitmaps(df).collect():
        keep = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8), count=r.n_lines)
        assert r.n_lines - int(keep.sum()) == r.n_dropped


def test_line_dedup_of_empty_table(spark):
    df = frame(spark, CASES).where("false")
    assert line_dedup.line_digests(df).count() == 0 and line_dedup.dedup_lines(df).count() == 0


# --- benchmark decontamination ------------------------------------------------

def words_brute(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits_brute(docs, items):
    out = []
    for i, t in docs:
        ws, hit, found = words_brute(t), set(), set()
        for item, text in items:
            iw = words_brute(text)
            m = min(10, len(iw))
            for s in range(len(iw) - m + 1) if iw else ():
                for d in range(len(ws) - m + 1):
                    if ws[d:d + m] == iw[s:s + m]:
                        hit.update(range(d, d + m))
                        found.add("" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((i, len(ws), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short Item here"),
         (10, "short item HERE"), (3, None), (4, ""), (5, "..."), (6, "lone"), (7, "été à la plage"),
         (8, "a a a a a a a a a a a a a a"), (None, "no id item text"), (8, "again the same id with other words in it so long")]
DOCS4 = [None, "", "...", "x one two three four five six seven eight nine ten y",
         "one, two; three four-five six seven eight nine ten eleven twelve thirteen", "short item here short item here",
         "LONE lone", "Été À la plage", "a " * 40, "b " + "a " * 12 + "b", "no id item text", "lonely",
         "again the same id with other words in it so long short item here", "word " * 30_000 + "short item here",
         (3, "short item here"), (3, "short item here"), (None, "lone")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination_equals_brute_force(spark, block_bytes):
    docs = frame(spark, DOCS4)
    bench = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, body int")
    got = decontaminate.contamination_report(docs, bench, block_bytes=block_bytes).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == hits_brute(rows, ITEMS)
    kept = decontaminate.decontaminate(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[-1] for r in hits_brute(rows, ITEMS))


def test_repeated_items_do_not_fill_a_block(spark, monkeypatch):
    sizes, real = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, v: (
        sizes.append(sum(len(body) for _, body in v)), real(self, v))[1])
    items = [(1, "the very same words in every one of these items here")] * 20 + [(9, "lone")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, ["some lone word", "the very same words in every one of these items here", "none"])
    got = decontaminate.contamination_report(docs, bench, block_bytes=200).collect()
    kept = decontaminate.decontaminate(docs, bench, block_bytes=200)
    assert sorted(r.n_items for r in got) == [0, 1, 1] and kept.count() == 1
    assert sizes and max(sizes) <= 200


def test_contamination_without_items_or_documents(spark):
    docs = frame(spark, DOCS4)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = decontaminate.contamination_report(docs, bench.where("false")).collect()
    assert len(none) == len(DOCS4) and not any(r.contaminated for r in none)
    assert decontaminate.contamination_report(docs.where("false"), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).count() == len(DOCS4)


# --- packing --------------------------------------------------------------------

def check_packing(rows, capacity):
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


def test_pieces_round_trip_and_packing(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "Hello, World!", "don't  stop\t now\r\n", "Straße ΣΑΣ, É. ＡＢ １２３", "word " * 9000,
             "<|endoftext|> x<|startoftext|>", (3, "again"), (3, "again"), (None, "no id"), "x" * 50_000]
    df = frame(spark, texts)
    rows = packing.pack(packing.token_pieces(df, default_tokenizer())).collect()
    model = Tokenizer.from_file(default_tokenizer())
    expected = []
    for r in df.collect():
        ids = np.array(model.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        expected += [(r.doc_id, k, k * 4096, len(ids[k * 4096:][:4096]), zlib.crc32(ids[k * 4096:][:4096].tobytes()))
                     for k in range(-(-len(ids) // 4096))]
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == sorted(expected, key=str)
    total = sum(r.length for r in rows)
    assert check_packing(rows, 4096) <= -(-total // 4096) + 1


def test_packing_plan_uses_every_piece_near_the_bound():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 500, 20_000):
        lengths = np.minimum(4096, np.maximum(1, rng.lognormal(5.5, 1.3, n).astype(int)))
        sizes, counts = np.unique(lengths, return_counts=True)
        plan = packing.packing_plan(dict(zip(sizes.tolist(), counts.tolist())))
        used = defaultdict(int)
        for config, times in plan:
            assert sum(config) <= 4096
            for s in config:
                used[s] += times
        assert used == dict(zip(sizes.tolist(), counts.tolist()))
        assert sum(t for _, t in plan) <= np.ceil(lengths.sum() / 4096 * 1.002) + 1


def test_packing_where_nothing_fits_beside(spark):
    """Pieces over half the capacity take a sequence each."""
    plan = packing.packing_plan({3000: 5, 2049: 4, 4096: 2})
    assert sum(t for _, t in plan) == 11


def test_packing_of_empty_table(spark):
    df = frame(spark, [""]).where("false")
    assert packing.pack(packing.token_pieces(df, default_tokenizer())).count() == 0


def test_hot_length_is_spread(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    rows = packing.pack(packing.token_pieces(df, default_tokenizer())).collect()
    each = rows[0].length
    assert check_packing(rows, 4096) == -(-3000 // (4096 // each))


# --- language identification ------------------------------------------------------

SAMPLE = {"en": "the quick brown fox jumps over the lazy dog and runs with the other foxes through the night ",
          "de": "der schnelle braune fuchs springt über den faulen hund und läuft mit den anderen durch die nacht ",
          "fr": "le renard brun et rapide saute par dessus le chien paresseux et court avec les autres la nuit "}


def test_suffix_automaton_gives_longest_matches():
    rng = np.random.default_rng(1)
    for _ in range(30):
        text = rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint8)
        probe = rng.integers(0, 4, 64).astype(np.uint8)
        table = language_id.suffix_automaton(text, 5)   # codes 0..3, 4 pads
        got = int(language_id.phrases(probe[None], table)[0])
        whole, match, n = bytes(text), b"", 1
        for c in probe.tolist():   # by plain search; a letter that the text lacks is a phrase's first
            match += bytes([c])
            if match not in whole:
                n, match = n + 1, bytes([c]) if c in whole else b""
        assert got == n


def test_language_id_learns_and_defines_edge_cases(spark):
    texts, langs = [], []
    for k in range(60):
        for lang, t in SAMPLE.items():
            words = t.split()
            texts.append(" ".join(words[(k + j * 7) % len(words)] for j in range(12)))
            langs.append(lang)
    texts += [None, "", "123 !?", "\n", "der hund", "x" * 300_000, (None, "the dog")]
    langs += [None, "en", "en", "fr", None, None, None]
    df = frame(spark, texts, langs)
    rows = {r.doc_id: r for r in language_id.language_id(df).collect()}
    assert len(rows) == len(texts)
    labelled = [(rows[i + 1], lang) for i, lang in enumerate(langs[:180])]
    assert np.mean([r.lang_pred == lang for r, lang in labelled if r.held_out]) > 0.95
    for k in range(180, 184):
        assert rows[k + 1].lang_pred == "und" and rows[k + 1].score == 0
    assert rows[185].lang_pred == "de" and rows[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items() if i is not None)


def test_no_language_is_lost_to_long_texts_or_one_id(spark):
    """German texts of 88,000 characters; French rows that all have one id."""
    words = {k: t.split() for k, t in SAMPLE.items()}
    rng = np.random.default_rng(9)
    say = lambda lang, n: " ".join(rng.choice(words[lang], n))
    rows = [(k, say("en", 12), "en") for k in range(60)] + [(100 + k, say("de", 17_000)[:88_000], "de") for k in range(12)]
    for one_id in range(7, 40):   # ids that are learned from
        if zlib.crc32(str(one_id).encode()) % 3 != 1:
            break
    rows += [(one_id, say("fr", 12), "fr") for _ in range(300)]
    rows += [(one_id + 1000, say("fr", 12), None), (5000, say("de", 12), None), (5001, say("en", 12), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language_id.labelled_texts(df)
    assert sorted(learned) == ["de", "en", "fr"]
    assert all(0 < sum(map(len, t)) <= language_id.CHARS // 3 for t in learned.values()) and len(learned["fr"]) == 64
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(df).collect()}
    assert (got[one_id + 1000], got[5000], got[5001], got[100]) == ("fr", "de", "en", "de")
    # one text in all rows of a language, and more values of lang than are learned
    same = spark.createDataFrame([(one_id, "le renard brun", "fr")] * 500 + [(k, "the dog", f"x{k % 40:02d}") for k in range(400)],
                                 "doc_id long, text string, lang string")
    learned = language_id.labelled_texts(same, languages=5)
    assert len(learned) == 5 and learned["fr"] == ["le renard brun"]


def test_language_id_without_labels(spark):
    df = frame(spark, ["some text", None], [None, None])
    assert {r.lang_pred for r in language_id.language_id(df).collect()} == {"und"}
    assert language_id.language_id(df.where("false")).count() == 0
