"""What the ALS queries hand to the library: kept ratings of numbers alone, so
the joins above them run once, and ids that come back after the scoring."""

from __future__ import annotations

import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from cadenza.plans import cf
from cadenza.registry import QUERIES
from cadenza.sources import derived


@pytest.fixture
def fitted_on(monkeypatch):
    """The columns and the storage of every input of a fit."""
    seen, fit = [], ALS.fit

    def recorded(self, dataset, params=None):
        seen.append((dataset.columns, dataset.storageLevel.useMemory))
        return fit(self, dataset, params)
    monkeypatch.setattr(ALS, "fit", recorded)
    return seen


@pytest.mark.parametrize("name", ["als_explicit_scores", "als_save_load"])
def test_fit_reads_kept_numbers(spark, sf, fitted_on, name):
    QUERIES[name](spark, sf)
    assert fitted_on == [(["user_ix", "item_ix", "rating"], True)]


def test_scores_equal_those_of_pairs_that_carry_their_ids(spark):
    plays = spark.createDataFrame([(f"u{u}", f"s{s}", 1.0 + (u * s) % 5) for u in range(12) for s in range(9)
                                   if (u + s) % 3], "user_id string, song_id string, play_count double")
    r, users, items = cf.als_ratings(plays)
    model = cf.fit_als(cf.make_als(2, 0.1, 2, implicit=False), r)
    columns = ["user_id", "song_id", "prediction"]
    plain = cf.score_pairs(model, r).select(columns).collect()
    named = cf.score_named(model, r.select("user_ix", "item_ix"), users, items).select(columns).collect()
    assert sorted(plain) == sorted(named) and len(plain) == plays.count()


def test_plays_meet_by_numbers(spark):
    lines = spark.createDataFrame([(1, 7), (1, 7), (1, None), (None, 7)], "o_custkey long, l_partkey long")
    got = derived.count_plays(lines)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "o_custkey" in exchange and got.schema["user_id"].dataType.simpleString() == "string"
    assert sorted(got.collect(), key=str) == sorted(
        spark.createDataFrame([("1", "7", 2), ("1", None, 1), (None, "7", 1)], got.schema).collect(), key=str)


def test_ids_of_a_cheaper_table(spark):
    plays = spark.createDataFrame([("b", "x", 1.0), ("a", "y", 2.0), (None, "z", 3.0)],
                                  "user_id string, song_id string, play_count double")
    own = cf.als_ratings(plays.where("user_id is not null"))
    other = cf.als_ratings(plays.where("user_id is not null").withColumn("play_count", F.lit(5.0)),
                           ids_of=plays.where("user_id is not null"))
    assert own[1].collect() == other[1].collect() and own[2].collect() == other[2].collect()


def few_plays(spark):
    rows = [(f"u{u:02d}", f"s{s:02d}", 1.0 + (u * s) % 5) for u in range(30) for s in range(20) if (u + s) % 3]
    return spark.createDataFrame(rows, "user_id string, song_id string, play_count double")


@pytest.fixture
def many(monkeypatch):
    """Every table of ratings counts as a large one; the storage of what fits read, and of their blocks."""
    seen, fit = [], ALS.fit

    def recorded(self, dataset, params=None):
        if params is not None:
            return self.copy(params).fit(dataset)
        seen.append((dataset.storageLevel.useMemory, self.getIntermediateStorageLevel(), self.getFinalStorageLevel(),
                     self.getCheckpointInterval()))
        return fit(self, dataset)
    monkeypatch.setattr(ALS, "fit", recorded)
    monkeypatch.setattr(cf, "IN_MEMORY", 0)
    return seen


def cached_in_memory(spark):
    kept = spark.sparkContext._jsc.getPersistentRDDs()
    return [k for k in kept.keySet() if kept[k].getStorageLevel().useMemory()]


def test_many_ratings_leave_memory_to_the_blocks(spark, many, monkeypatch):
    r = cf.als_ratings(few_plays(spark))[0]
    model = cf.fit_als(cf.make_als(2, 0.1, 3), r)
    assert many == [(False, "DISK_ONLY", "DISK_ONLY", 2)]
    monkeypatch.setattr(cf, "IN_MEMORY", 1000)
    other = cf.fit_als(cf.make_als(2, 0.1, 3), r)
    assert many[1] == (True, "MEMORY_AND_DISK", "MEMORY_AND_DISK", 10)
    for a, b in ((model.userFactors, other.userFactors), (model.itemFactors, other.itemFactors)):
        assert sorted(a.collect()) == sorted(b.collect()) and a.count()


def test_a_grid_of_many_ratings_keeps_them_on_disk(spark, many):
    before = set(cached_in_memory(spark))
    cf.grid_search(spark, cf.als_ratings(few_plays(spark))[0], ranks=[2], regs=[0.1, 1.0], alphas=[1.0], iters=[2])
    assert len(many) == 2 and {m[1:] for m in many} == {("DISK_ONLY", "DISK_ONLY", 2)}
    assert not set(cached_in_memory(spark)) - before


def test_a_validation_split_of_many_ratings_keeps_them_on_disk(spark, many, monkeypatch):
    r = cf.als_ratings(few_plays(spark))[0]
    seen, before = [], set(cached_in_memory(spark))
    transform = cf.ALSModel.transform
    monkeypatch.setattr(cf.ALSModel, "transform", lambda self, df, *a: seen.extend(
        [df.storageLevel.useMemory, *(set(cached_in_memory(spark)) - before)]) or transform(self, df, *a))
    rows, _ = cf.grid_search_tvs(r, ranks=[2], regs=[0.1, 1.0], alphas=[1.0], iters=[2])
    assert seen == [False, False] and {m[1] for m in many} == {"DISK_ONLY"}
    monkeypatch.setattr(cf, "IN_MEMORY", 1000)
    assert rows.collect() == cf.grid_search_tvs(r, ranks=[2], regs=[0.1, 1.0], alphas=[1.0], iters=[2])[0].collect()
    assert True in seen


def test_blocks_follow_the_ratings(monkeypatch):
    monkeypatch.setattr(cf, "RATINGS_A_BLOCK", 100)
    als = cf.make_als()
    assert [cf.sized(als, n).getNumUserBlocks() for n in (0, 1000, 1001, 5000)] == [10, 10, 11, 50]
    assert cf.sized(als, 5000).getNumItemBlocks() == 50 and als.getNumUserBlocks() == 10
