"""The resumable grid and boosting over linear SVMs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors

from cadenza import registry
from cadenza.plans import cf, genre
from cadenza.session import scratch_path

GRID = dict(ranks=[2, 3], regs=[0.1, 1.0, 5.0], alphas=[1.0], iters=[2])


def ratings_of(spark):
    rng = np.random.default_rng(0)
    rows = [(str(u), str(i), float(1 + (u * i) % 5)) for u in range(30) for i in rng.choice(40, 15, replace=False)]
    return cf.als_ratings(spark.createDataFrame(rows, "user_id string, song_id string, play_count double"))[0].checkpoint()


class Lost(Exception):
    pass


def test_a_grid_that_was_cut_off_goes_on(spark, monkeypatch):
    ratings, path = ratings_of(spark), scratch_path(spark, "grid")
    want, _, best = cf.grid_search(spark, ratings, **GRID)
    fits, make = [], cf.make_als

    def failing(rank, reg, iters, alpha, implicit):
        if len(fits) == 3:
            raise Lost
        fits.append((rank, reg))
        return make(rank, reg, iters, alpha, implicit)
    monkeypatch.setattr(cf, "make_als", failing)
    with pytest.raises(Lost):
        cf.grid_search(spark, ratings, **GRID, results=path)
    assert len(cf._finished(spark, path)) == 3 and not ratings.is_cached

    again = []
    monkeypatch.setattr(cf, "make_als", lambda *a: again.append(a[:2]) or make(*a))
    res, model, found = cf.grid_search(spark, ratings, **GRID, results=path, parallelism=2)
    assert sorted(again)[:3] and len(set(again) - set(fits)) == 3 and len(again) <= 4   # the best may be fitted once more
    assert sorted(map(tuple, res.collect())) == sorted(map(tuple, want.collect())) and found == best
    assert model.rank == best["rank"] and len(cf._finished(spark, path)) == 6

    again.clear()
    res, model, _ = cf.grid_search(spark, ratings, **GRID, results=path)   # nothing is left but the best model
    assert again == [(best["rank"], best["reg_param"])] and model is not None
    assert sorted(map(tuple, res.collect())) == sorted(map(tuple, want.collect()))


def test_the_grid_query_has_all_settings_of_the_source(spark, sf, monkeypatch):
    asked, search = [], cf.grid_search

    def first_only(spark, ratings, ranks=cf.FULL_GRID["ranks"], regs=cf.FULL_GRID["regs"], alphas=cf.FULL_GRID["alphas"],
                   iters=cf.FULL_GRID["iters"], **more):
        asked.append([(r, g, a, i) for r in ranks for g in regs for a in alphas for i in iters])
        return search(spark, ratings, ranks=[2], regs=[1.0], alphas=[1.0], iters=[1])
    monkeypatch.setattr(cf, "grid_search", first_only)
    registry.QUERIES["als_grid"](spark, sf).collect()
    assert len(asked[0]) == len(set(asked[0])) == 108 and {x[3] for x in asked[0]} == {20}
    assert [sorted({x[k] for x in asked[0]}) for k in (0, 2)] == [[8, 10, 12], [1.0, 10.0, 50.0, 100.0]]


def test_small_fits_go_several_at_a_time():
    assert [cf.fits_at_a_time(n) for n in (0, 1000, 2 * cf.IN_MEMORY // 5, cf.IN_MEMORY, 10 * cf.IN_MEMORY)] == [8, 8, 2, 1, 1]


def boosted_fixture(spark, n=150, k=3, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    x = rng.normal(size=(n, 4)) + np.eye(4)[y] * 1.2
    df = spark.createDataFrame([(f"t{i:03d}", Vectors.dense(v), float(c)) for i, (v, c) in enumerate(zip(x, y))],
                               ["track_id", "features", "label"])
    return df, x, y


def test_boosting_equals_numpy(spark):
    """Margins, errors, votes and weights from the fitted planes alone."""
    df, x, y = boosted_fixture(spark)
    got = genre.fit_boosted_svm(df, rounds=4, max_iter=20)
    assert len(got.models) >= 2
    w, votes = np.ones(len(y)), np.zeros((len(y), 3))
    for model, alpha, error in zip(got.models, got.alphas, got.errors):
        margins = np.stack([x @ m.coefficients.toArray() + m.intercept for m in model.models], axis=1)
        wrong = margins.argmax(axis=1) != y
        assert error == pytest.approx((w * wrong).sum() / w.sum(), abs=1e-12)
        assert alpha == pytest.approx(math.log((1 - error) / error) + math.log(2), abs=1e-12)
        w = w * np.where(wrong, math.exp(alpha), 1.0)
        w *= len(y) / w.sum()
        votes[np.arange(len(y)), margins.argmax(axis=1)] += alpha
    weights = {r.track_id: r.weight for r in got.weights.collect()}
    assert np.allclose([weights[f"t{i:03d}"] for i in range(len(y))], w)
    rows = sorted(got.transform(df).collect(), key=lambda r: r.track_id)
    assert [r.prediction for r in rows] == votes.argmax(axis=1).tolist()
    for r, v in zip(rows, votes):
        assert {c: pytest.approx(a) for c, a in map(tuple, r.votes)} == {float(c): a for c, a in enumerate(v) if a}


def test_boosting_uses_the_weights(spark):
    """The second round is fitted to the weights, not to the plain rows."""
    df, _, _ = boosted_fixture(spark)
    got = genre.fit_boosted_svm(df, rounds=2, max_iter=20)
    a, b = [[m.coefficients.toArray() for m in model.models] for model in got.models]
    assert not np.allclose(a, b)


def test_boosting_ends_early(spark):
    df, x, _ = boosted_fixture(spark)
    apart = spark.createDataFrame([(f"t{i}", Vectors.dense([10.0 * (i % 2), 1.0]), float(i % 2)) for i in range(40)],
                                  ["track_id", "features", "label"])
    got = genre.fit_boosted_svm(apart, rounds=5)
    assert got.errors == [0.0] and len(got.models) == 1
    assert all(r.prediction == r.label for r in got.transform(apart).collect())


def test_boosted_svm_query(spark, sf):
    rows = registry.QUERIES["genre_boosted_svm"](spark, sf).collect()
    assert rows and {r.prediction for r in rows} <= {float(c) for c in range(10)}
    assert {r.track_id for r in rows} == {r.track_id for r in registry.QUERIES["genre_svm"](spark, sf).collect()}


def test_all_classes_are_fitted_at_a_time(spark, monkeypatch):
    from pyspark.ml.classification import OneVsRest
    seen, fit = [], OneVsRest.fit

    def recorded(self, dataset, params=None):
        seen.append(self.getParallelism())
        return fit(self, dataset, params)
    monkeypatch.setattr(OneVsRest, "fit", recorded)
    rows = spark.createDataFrame([(str(i), [float(i % 3), float(i % 2)], float(i % 3)) for i in range(30)],
                                 "track_id string, f array<double>, label double")
    genre.fit_boosted_svm(rows.select("track_id", array_to_vector("f").alias("features"), "label"), rounds=1, max_iter=2)
    assert seen == [10]
