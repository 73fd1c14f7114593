"""Candidates of near-dedup: recall at the threshold on both sides of
``SMALL``, and how many unrelated sets share a band."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cadenza.llm import near_dedup as nd

from .test_document_operators import frame

NONE = np.zeros(0, np.uint64)


def hashes(rng, n):
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)


def pair(rng, n, percent):
    """A set of n and one that is exactly as similar as it must be, or just above."""
    both = -(-n * percent // 100)
    pool = hashes(rng, n)
    return np.sort(pool), np.sort(pool[:both])


def met(pairs, percent):
    """Whether each pair shares a key: bands are for sets above SMALL."""
    width = nd.band_width(percent)
    a, b = [nd._bands_of(nd.registers([p[k] for p in pairs]), width) for k in (0, 1)]
    found = ((a == b).all(axis=2) & nd._filled(a)).any(axis=1) & np.array([min(map(len, p)) > nd.SMALL for p in pairs])
    most = nd.SMALL * 100 // percent
    for k, (x, y) in enumerate(pairs):
        if not found[k] and len(x) <= most and len(y) <= most:
            found[k] = bool(len(np.intersect1d(*[nd.prefix(s, percent, NONE, NONE.astype(np.int64)) for s in (x, y)])))
    return found


@pytest.mark.parametrize("percent", [80, 85])
def test_every_pair_of_1_to_500_shingles_meets(percent):
    rng = np.random.default_rng(percent)
    pairs = [pair(rng, n, percent) for n in range(1, 501) for _ in range(12)]
    assert met(pairs, percent).all()


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_of_bands_alone_above_the_small_sets(percent):
    """The worst case: the smaller set is one above ``SMALL``.  80 %: 1.3e-6
    to be missed, so 40,000 pairs lose one with a chance of 5 %."""
    rng = np.random.default_rng(1)
    n = (nd.SMALL + 1) * 100 // percent
    lost = 0
    for _ in range(20):
        lost += int((~met([pair(rng, n, percent) for _ in range(1000)], percent)).sum())
    assert lost == 0


def test_unrelated_sets_share_no_band_however_small():
    """20,000 sets of 1 to 400 shingles: with one filled register a band, a
    hundred thousand pairs met by chance."""
    rng = np.random.default_rng(2)
    width = nd.band_width(80)
    bands = nd._bands_of(nd.registers([np.sort(hashes(rng, int(n))) for n in rng.integers(1, 400, 20_000)]), width)

    def by_chance(usable):
        pairs = 0
        for k in range(nd.BANDS):
            _, n = np.unique(bands[usable[:, k], k], axis=0, return_counts=True)
            pairs += int((n * (n - 1) // 2).sum())
        return pairs
    assert by_chance(nd._filled(bands)) <= 3
    assert by_chance((bands > 0).any(axis=2)) > 10_000


@pytest.mark.parametrize("size,percent", [(5, 80), (3, 85)])
def test_pairs_at_the_threshold_are_linked(spark, size, percent):
    """Texts of 1 to 500 shingles and their beginnings, exactly at the threshold."""
    rng = random.Random(7)
    texts, want = [], []
    for n in list(range(1, 60, 3)) + list(range(60, 501, 20)):
        words = ["w%d" % rng.randrange(10 ** 9) for _ in range(n + size - 1)]
        least = -(-n * percent // 100)   # shingles of the shortest similar beginning
        texts += [" ".join(words), " ".join(words[:least + size - 1]), " ".join(words[:max(least - 1, 0) + size - 1])]
        short = max(least - 1, 0)
        want.append((True, 100 * short >= percent * least))
    got = [r.component_id for r in sorted(nd.near_duplicates(frame(spark, texts), size=size, percent=percent).collect(),
                                          key=lambda r: r.doc_id)]
    for k, (_, chained) in enumerate(want):
        a, b, c = got[3 * k:3 * k + 3]
        assert a == b
        assert (c == a) == chained


def test_shared_shingles_and_spanning_links():
    rng = np.random.default_rng(3)
    pool = hashes(rng, 60)
    sets = [np.sort(rng.choice(pool, int(k), replace=False)) for k in rng.integers(0, 50, 30)]
    left, right = sets[:13], sets[13:]
    want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
    old, nd.COLUMNS = nd.COLUMNS, 7
    try:
        assert nd._shared_shingles(left, right).tolist() == want
        assert nd._shared_shingles([], []).shape == (0, 0)
    finally:
        nd.COLUMNS = old
    a, b = rng.integers(0, 20, 80), rng.integers(0, 20, 80)
    kept = nd._spanning(a, b)

    def classes(pairs):
        name = list(range(20))
        for x, y in pairs:
            name = [name[y] if c == name[x] else c for c in name]
        return [[i for i in range(20) if name[i] == name[k]] for k in range(20)]
    assert classes([(a[k], b[k]) for k in kept]) == classes(zip(a, b)) and len(kept) < 20


@pytest.mark.parametrize("percent", [80, 85])
def test_marks_exclude_no_similar_pair_and_nearly_all_others(percent):
    rng = np.random.default_rng(percent)

    def side(sets, first):
        return {"n_shingles": np.array([len(s) for s in sets]), "root": first + np.arange(len(sets)),
                "mark": np.packbits(nd.marks(sets), axis=1), "known": np.ones(len(sets), dtype=bool)}
    alike = [pair(rng, n, percent) for n in range(1, 321) for _ in range(3)]
    ok = nd._may_link(side([a for a, _ in alike], 0), side([b for _, b in alike], 10_000), percent)
    assert ok.diagonal().all()
    sets = [np.sort(hashes(rng, n)) for n in range(20, 300)]
    assert nd._may_link(side(sets, 0), side(sets, 0), percent).sum() == 0   # no set is compared with itself
    known = side(sets, 0) | {"known": np.zeros(len(sets), dtype=bool)}
    n = known["n_shingles"]
    large = (n[:, None] > nd.SMALL) & (n[None] > nd.SMALL) & (n[:, None] != n[None])
    assert (nd._may_link(known, known, percent) == large).all()   # without marks, bands and registers tell


def test_shingles_are_fetched_for_nodes_that_may_be_linked_only(spark, monkeypatch):
    """300 texts in 60 groups of unrelated ones with a rare shingle in common:
    each used to take its shingles to the group."""
    rng = random.Random(3)
    rows = [(k, " ".join(["rare", f"r{k % 60}", "words"] + [f"w{rng.randrange(10**9)}" for _ in range(40)]))
            for k in range(300)]
    base = [f"b{k}" for k in range(60)]
    rows += [(1000 + k, " ".join(base[:59] + [f"x{k}"] + base[59:])) for k in range(6)]
    fetched, only = [], nd._only

    def counted(found, ids, key="set_id"):
        if {"regs", "small"} <= set(found.columns):
            fetched.append(ids.count())
        return only(found, ids, key)
    monkeypatch.setattr(nd, "_only", counted)
    monkeypatch.setattr(nd, "HOT", 0)   # as with more common shingles than are kept
    got = {r["doc_id"]: r["component_id"]
           for r in nd.near_duplicates(frame(spark, rows), size=3, percent=85).collect()}
    assert got == {k: 1000 if k >= 1000 else k for k, _ in rows}
    assert len(fetched) == 1 and fetched[0] <= 6
