"""The packing's linear program: it converges, and it makes the result."""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import packing


def used(plan):
    out = Counter()
    for config, times in plan:
        for s in config:
            out[s] += times
    return out


def best_fit_alone(histogram, capacity):
    count = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        count[s] = n
    return sum(t for _, t in packing._best_fit(count, capacity))


def corpus(n, seed, most=4096):
    """Lengths like documents' pieces, full pieces among them."""
    rng = np.random.default_rng(seed)
    length = np.maximum(1, rng.lognormal(6.2, 1.1, n).astype(int))
    return Counter(np.where(length > most, rng.integers(1, most + 1, n), length).tolist()) + Counter({most: n // 40})


@pytest.mark.parametrize("n,times", [(1000, 1), (10_000, 1), (10_000, 26)])
def test_the_gap_is_small_and_configurations_place_the_pieces(n, times):
    histogram = {s: c * times for s, c in corpus(n, n).items()}
    plan, placed, bound = packing.packing_plan(histogram, with_bound=True)
    pieces, sequences = sum(histogram.values()), sum(t for _, t in plan)
    assert used(plan) == histogram and all(sum(c) <= 4096 for c, _ in plan)
    assert bound >= sum(s * c for s, c in histogram.items()) / 4096 - 1e-6
    assert bound <= sequences <= max(bound * 1.005, bound + 1)
    assert sequences <= best_fit_alone(histogram, 4096)
    assert placed > 0.97 * pieces
    several = sum(t * len(c) for c, t in plan if len(c) > 1)
    assert several > 0.9 * (pieces - histogram[4096])     # not only the full pieces


def brute_bound(histogram, capacity):
    """Least sequences, by search."""
    pieces = sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True)
    best = [len(pieces)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(pieces):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms), reverse=True):
            if r >= pieces[k]:
                rest = list(rooms)
                rest.remove(r)
                place(k + 1, rest + [r - pieces[k]])
        place(k + 1, rooms + [capacity - pieces[k]])
    place(0, [])
    return best[0]


def test_small_histograms_against_search():
    rng = np.random.default_rng(4)
    for _ in range(60):
        histogram = Counter(rng.integers(1, 21, int(rng.integers(1, 9))).tolist())
        plan, _, bound = packing.packing_plan(histogram, 20, with_bound=True)
        least = brute_bound(histogram, 20)
        assert used(plan) == histogram
        assert bound <= least + 1e-9 and sum(t for _, t in plan) <= least + 1


@pytest.mark.parametrize("histogram,least", [
    ({3000: 500}, 500), ({2049: 7, 2048: 4}, 9), ({1: 1_000_000}, 245), ({4096: 3}, 3), ({1500: 10, 2500: 10}, 10),
    ({1366: 9}, 5), ({3000: 300, 1000: 300, 96: 300}, 300)])
def test_lengths_that_do_not_fill_a_sequence(histogram, least):
    plan, _, bound = packing.packing_plan(histogram, with_bound=True)
    assert used(plan) == histogram and sum(t for _, t in plan) == least
    assert least - 1 < bound <= least + 1e-6


def test_fill_is_the_dearest():
    rng = np.random.default_rng(2)
    for _ in range(100):
        sizes = np.sort(rng.choice(np.arange(1, 15), 4, replace=False))
        have, price = rng.integers(0, 4, 15), rng.random(15)
        best = max(sum(n * price[s] for s, n in zip(sizes, c)) for c in itertools.product(*[range(have[s] + 1) for s in sizes])
                   if sum(n * s for s, n in zip(sizes, c)) <= 20)
        got = packing._fill(20, sizes, price, have)
        assert all(n <= have[s] for s, n in got.items()) and sum(s * n for s, n in got.items()) <= 20
        assert abs(sum(n * price[s] for s, n in got.items()) - best) < 1e-9
