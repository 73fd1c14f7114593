"""What a task sorts, what a search leaves on disk, which lists are packed."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from cadenza import registry
from cadenza.operators import similar as sim_ops
from cadenza.operators.history import listening_history
from cadenza.plans import cf
from cadenza.sources import derived


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dealt_history_is_the_plain_one(spark):
    songs = spark.createDataFrame(
        [(str(i), str(i % 90), None if i % 7 == 0 else f"t{i % 40}", None if i % 11 == 0 else f"a{i % 3}", float(i), 2000)
         for i in range(120)], "track_id string, song_id string, title string, artist_name string, duration double, year int")
    plays = spark.createDataFrame([(None if u == 5 else str(u), str(s), 1 + (u * s) % 4) for u in range(6) for s in range(15 * u)],
                                  "user_id string, song_id string, play_count bigint")
    plain, dealt = listening_history(plays, songs, 12), listening_history(plays, songs, 12, tasks=5)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)


def test_tasks_of_the_history_follow_the_lines(spark, sf, monkeypatch):
    want = rows(registry.QUERIES["listening_history"](spark, sf))
    monkeypatch.setattr(derived, "LINES_A_TASK", 300)
    tasks = derived.play_tasks(spark, sf)
    got = registry.QUERIES["listening_history"](spark, sf)
    assert tasks > 8 and got.rdd.getNumPartitions() == tasks and rows(got) == want


def test_a_grid_leaves_only_its_best_model(spark):
    rng = np.random.default_rng(0)
    plays = spark.createDataFrame([(str(u), str(i), float(1 + (u * i) % 5)) for u in range(20)
                                   for i in rng.choice(30, 12, replace=False)], "user_id string, song_id string, play_count double")
    ratings = cf.als_ratings(plays)[0].checkpoint()
    kept = spark.sparkContext._jsc.getPersistentRDDs
    before = set(kept().keySet())
    _, model, _ = cf.grid_search(spark, ratings, ranks=[2], regs=[0.1, 0.5, 1.0, 2.0, 4.0, 8.0], alphas=[1.0], iters=[2], implicit=False)
    for _ in range(50):   # three RDDs of the best model, three of the last; the cleaner works beside the driver
        left = set(kept().keySet()) - before
        if len(left) <= 6:
            break
        time.sleep(0.2)
    assert len(left) <= 6 and model.userFactors.count() == 20


def test_only_lists_of_played_tracks_are_packed(spark, sf, monkeypatch):
    plays = derived.plays(spark, sf).where(F.col("user_id").cast("long") % 50 == 0).checkpoint()
    songs, sim, packed = derived.songs(spark, sf), derived.similar(spark, sf).checkpoint(), []
    want = rows(sim_ops.similar_items_topk(plays, songs, sim))
    pack = sim_ops.packed_lists
    monkeypatch.setattr(sim_ops, "packed_lists", lambda s: packed.append(s) or pack(s))
    assert rows(sim_ops.similar_items_topk(plays, songs, sim, few=True)) == want
    tids = {r.tid for r in packed[0].select("tid").distinct().collect()}
    assert tids and tids <= {r.song_id for r in plays.select("song_id").distinct().collect()}
    assert len(tids) < sim.select("tid").distinct().count()
