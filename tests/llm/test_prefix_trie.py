"""The prefix trie against a trie built turn by turn, and its range minima."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from cadenza.llm import prefix_trie as trie

DDL = "conv_id long, turn long, role string, text string, l int, depth int, keys string, chars int, part int, ids string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def frame(spark, rows):
    """Turns with columns that bear the operator's inner names."""
    return spark.createDataFrame([(*r, 1, 2, "k", 3, 4, "i") for r in rows], DDL)


def in_order(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, role, key, text))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}


def opened(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute(convs):
    """Nodes as a dictionary of prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += own
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items()) if convs else []


def check(spark, rows, shared=True, **options):
    seqs = trie.sequences(frame(spark, rows))
    got = trie.prefix_trie(trie.shared_openings(seqs) if shared else seqs, **options)
    assert got.columns == list(COLUMNS)
    assert sorted(tuple(r) for r in got.collect()) == brute(opened(in_order(rows)) if shared else in_order(rows))


def random_convs(rng, n, words, most, first=0):
    return [(first + c, t, rng.choice(["user", "assistant", None]), rng.choice(words))
            for c in range(n) for t in range(rng.randrange(most))]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    words = ["a", "bb", "", None, "é😀", "ccc"]
    check(spark, random_convs(rng, 320, words, 9) + random_convs(rng, 40, words[:2], 30, 500))


def test_edge_cases(spark):
    rows = [
        (1, 0, "u", "hi"), (1, None, "u", "null turn comes first"),
        (2, 5, None, None), (2, 5, None, None), (2, 5, "", ""),        # equal rows: three turns
        (3, 1, "b", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tie two"),  # equal numbers
        (None, 0, "u", "no conversation"), (-5, 0, "u", "negative"), (-105, 0, "u", "negative"),
        (100, 0, "u", "base"), (100, 1, "u", "of"), (100, 2, "u", "others"), (101, 0, "u", "x"), (163, 0, "u", "y"),
        (4, 0, "u", "x" * 100_000), (6, 0, "u", "x" * 100_000), (7, 0, "ab", "c"), (8, 0, "a", "bc"),
    ] + [(c, 0, "u", "one turn, cut where nothing opens") for c in range(300, 340)]
    check(spark, rows)
    check(spark, rows, shared=False)


def test_no_conversations(spark):
    check(spark, [])
    check(spark, [(None, 1, "u", "x")])


def test_one_conversation_most_have_crosses_tasks(spark):
    """Equal sequences, their prefixes and their continuations in many tasks."""
    rows = [(c, t, "u", f"turn {t}") for c in range(900) for t in range(3)]
    rows += [(c, t, "u", f"turn {t}") for c in range(1000, 1300) for t in range(2)]
    rows += [(c, t, "u", f"turn {t}") for c in range(2000, 2400) for t in range(4 + c % 2)]
    rows += [(c, 0, "u", f"alone {c}") for c in range(3000, 3030)]
    check(spark, rows, shared=False)
    check(spark, rows, shared=False, turns_a_task=100)


def test_one_task(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        check(spark, random_convs(random.Random(3), 100, ["a", "b"], 6))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_very_long_conversation(spark):
    rows = [(c, t, "u", "again") for c, n in ((1, 1500), (2, 1499), (3, 700)) for t in range(n)]
    check(spark, rows, shared=False)


def test_range_minima():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 64, 100):
        x = rng.integers(0, 6, n)
        r = trie.RangeMin(x)
        at, depth = [a.ravel() for a in np.meshgrid(np.arange(n), np.arange(8))]
        right = [next((k - 1 for k in range(i + 1, n) if x[k] < d), n - 1) for i, d in zip(at, depth)]
        left = [next((k for k in range(i, -1, -1) if x[k] < d), -1) for i, d in zip(at, depth)]
        assert r.right(at, depth).tolist() == right and r.left(at, depth).tolist() == left
        lo, hi = [a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n))]
        lo, hi = lo[lo <= hi], hi[lo <= hi]
        assert r.least(lo, hi).tolist() == [int(x[a:b + 1].min()) for a, b in zip(lo, hi)]
