"""Layer 3: quirks and edge cases of the relational operators, plus
brute-force checks of the operators whose oracle is not SQL-shaped."""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import functions as F

from cadenza.functions.features import score_class
from cadenza.operators import arrays, ids, metrics, ratings, sets
from cadenza.operators.history import split_known_users
from cadenza.operators.topk import dedupe_keep_best, top_k_per
from cadenza.sources import derived


def test_zero_max_user_gives_null(spark):
    df = spark.createDataFrame([("u", "s1", 0), ("u", "s2", 0), ("v", "s1", 4)],
                               "user_id string, song_id string, play_count int")
    out = {(r.user_id, r.song_id): r.norm_value
           for r in ratings.normalize_by_user_max(df).collect()}
    assert out[("u", "s1")] is None and out[("v", "s1")] == 10.0


def test_dedupe_keeps_higher_score_then_smaller_id(spark):
    df = spark.createDataFrame(
        [("b", "T", "A", 1.0), ("a", "T", "A", 2.0), ("d", "X", "Y", 3.0), ("c", "X", "Y", 3.0)],
        "track_id string, title string, artist_name string, score double")
    got = sorted((r.title, r.track_id) for r in
                 dedupe_keep_best(df, ["title", "artist_name"],
                                  [("score", "desc"), ("track_id", "asc")]).collect())
    assert got == [("T", "a"), ("X", "c")]


def test_bag_versus_set_difference(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    right = spark.createDataFrame([(2,)], "v int")
    assert sorted(r.v for r in sets.bag_difference(left, right).collect()) == [1, 1]
    assert sorted(r.v for r in sets.set_difference(left, right).collect()) == [1]


def test_bag_difference_is_null_safe(spark):
    left = spark.createDataFrame([(None,), (None,), (3,)], "v int")
    right = spark.createDataFrame([(None,)], "v int")
    assert [r.v for r in sets.bag_difference(left, right).collect()] == [3]


def test_hash_collision_fans_out_and_is_reported(spark):
    dim = spark.createDataFrame([("s1", 7), ("s2", 7), ("s3", 8)], "song_id string, hash_id long")
    scored = spark.createDataFrame([("u", 7, 1.0)], "user_id string, product long, rating double")
    assert sorted(r.song_id for r in ids.unhash(scored, dim).collect()) == ["s1", "s2"]
    rep = ids.collisions(dim).collect()
    assert sorted(r.song_id for r in rep) == ["s1", "s2"] and {r.n_ids for r in rep} == {2}


def test_unknown_user_in_request(spark):
    plays = spark.createDataFrame([("u1", "s", 1)], "user_id string, song_id string, play_count int")
    req = spark.createDataFrame([("u1",), ("nobody",)], "user_id string")
    known, unknown = split_known_users(req, plays)
    assert [r.user_id for r in known.collect()] == ["u1"]
    assert [r.user_id for r in unknown.collect()] == ["nobody"]


def test_score_class_truncates(spark):
    df = spark.createDataFrame([(0.99,), (9.99,), (10.0,), (None,)], "s double")
    assert [r.c for r in df.select(score_class("s").alias("c")).collect()] == [0, 9, 10, None]


def test_year_boundary(spark):
    df = spark.createDataFrame([(2009,), (2010,), (None,)], "year int")
    assert df.where(F.col("year") <= 2009).count() == 1
    assert df.where(F.col("year") > 2009).count() == 1


def test_global_positions_dense_under_a_hot_key(spark):
    rows = [(0, i) for i in range(3000)] + [(k, 0) for k in range(1, 500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    pos = ids.global_positions(df, ["k", "v"]).orderBy("k", "v").collect()
    assert [r.pos for r in pos] == list(range(len(rows)))


def test_dense_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    got = {r.x: r.x_ix for r in ids.dense_ids(df, "x", "x_ix").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_adjacency_similarity_matches_brute_force(spark, sf):
    li = pd.read_parquet(f"{sf}/lineitem.parquet").sort_values(
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).reset_index(drop=True)
    want = defaultdict(float)
    for i in range(len(li) - 1):
        a, b = li.iloc[i], li.iloc[i + 1]
        if a.l_orderkey == b.l_orderkey and a.l_partkey != b.l_partkey:
            want[(str(a.l_partkey), str(b.l_partkey))] += 1
            want[(str(b.l_partkey), str(a.l_partkey))] += 1
    got = {(r.tid, r.target): r.score for r in derived.similar(spark, sf).collect()}
    assert got == dict(want)


def test_ragged_slice_matches_python(spark):
    files = {1: (list(map(float, range(100, 110))), [0, 3, 8]), 2: (list(map(float, range(200, 207))), [0, 6]),
             3: ([0.0, 1.0, 2.0, 3.0, 4.0], [0, 2, 2, 5]), 4: ([7.0, 8.0], [0, 0, 0, 1]), 5: ([], [0, 0])}
    df = spark.createDataFrame([(f, v, s) for f, (v, s) in files.items()],
                               "file int, vals array<double>, starts array<int>")
    got = {(r.file, r.rec): (r.n, list(r.vals)) for r in arrays.ragged_slice(df).collect()}
    want = {}
    for f, (v, s) in files.items():   # empty first, middle and last records
        for i, a in enumerate(s):
            part = v[a:s[i + 1]] if i + 1 < len(s) else v[a:]
            want[(f, i)] = (len(part), part)
    assert got == want


def test_top_k_per_is_bounded_and_ordered(spark):
    df = spark.createDataFrame([("u", i, float(i % 7)) for i in range(100)],
                               "user_id string, item int, score double")
    out = top_k_per(df, ["user_id"], [F.col("score").desc(), F.col("item").asc()], 5).collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5]
    assert [r.item for r in out] == [6, 13, 20, 27, 34]


def test_ranking_metrics_brute_force(spark):
    recs = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3), ("v", "x", 1)],
                                 "user_id string, song_id string, rank int")
    held = spark.createDataFrame([("u", "b"), ("u", "z"), ("v", "y"), ("w", "q")],
                                 "user_id string, song_id string")
    out = {r.k: r for r in metrics.ranking_metrics(recs, held, [1, 3]).collect()}
    # users u, v, w have held-out items; only u has a hit (b at rank 2)
    assert out[1].precision_at_k == 0.0 and out[1].n_users == 3
    assert math.isclose(out[3].precision_at_k, (1 / 3) / 3)
    assert math.isclose(out[3].recall_at_k, (1 / 2) / 3)
    ndcg_u = (1 / math.log2(3)) / (1 + 1 / math.log2(3))
    assert math.isclose(out[3].ndcg_at_k, ndcg_u / 3)


def test_hash_split_is_deterministic_and_complete(spark, sf):
    p = derived.plays(spark, sf)
    a, b = ratings.hash_split(p, ["user_id", "song_id"], 0.8, 1)
    a2, _ = ratings.hash_split(p.repartition(3), ["user_id", "song_id"], 0.8, 1)
    assert a.count() + b.count() == p.count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, a2.collect()))
    assert 0.7 < a.count() / p.count() < 0.9


def test_error_and_accuracy_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "actual double, predicted double")
    r = metrics.error_metrics(df).first()
    assert r.n == 2 and r.mse == 0.5 and math.isclose(r.rmse, math.sqrt(0.5)) and r.mae == 0.5
    acc = metrics.accuracy(df.select(F.col("actual").alias("label"),
                                     F.col("predicted").alias("prediction"))).first()
    assert acc.accuracy == 0.5 and acc.error == 0.5


def test_user_cosine_brute_force(spark):
    rows = [("u", "a", 1.0), ("u", "b", 2.0), ("v", "a", 3.0), ("v", "b", 1.0), ("v", "c", 5.0),
            ("w", "c", 1.0)]
    plays = spark.createDataFrame(rows, "user_id string, song_id string, play_count double")
    req = spark.createDataFrame([("u",)], "user_id string")
    got = {r.other_user_id: (r.n_common, r.cosine)
           for r in arrays.user_cosine(plays, req).collect()}
    want = (1 * 3 + 2 * 1) / math.sqrt((1 + 4) * (9 + 1))
    assert set(got) == {"v"} and got["v"][0] == 2 and math.isclose(got["v"][1], want)


def test_checkpoint_dir_is_read_from_session(spark):
    from cadenza.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_global_positions_explicit_ranges(spark):
    df = spark.createDataFrame([(i % 13, i) for i in range(1000)], "k int, v int")
    pos = ids.global_positions(df, ["k", "v"], num_partitions=5).orderBy("k", "v").collect()
    assert [r.pos for r in pos] == list(range(1000))


def test_hybrid_merge_duplicates_and_dedupe(spark):
    from cadenza.plans.hybrid import hybrid_merge
    cols = "user_id string, track_id string, title string, artist_name string, " \
           "duration double, year int, predicted_score double"
    a = spark.createDataFrame([("u", "t1", "x", "y", 1.0, 2000, 9.0),
                               ("u", "t2", "x2", "y", 1.0, 2000, 5.0)], cols)
    b = spark.createDataFrame([("u", "t1", "x", "y", 1.0, 2000, 7.0)], cols)
    bag = hybrid_merge([("als", a), ("sim", b)], 40).collect()
    assert sorted((r.track_id, r.source) for r in bag) == [("t1", "als"), ("t1", "sim"),
                                                           ("t2", "als")]
    best = hybrid_merge([("als", a), ("sim", b)], 40, dedupe="max").collect()
    assert sorted((r.track_id, r.source, r["rank"]) for r in best) == [("t1", "als", 1),
                                                                       ("t2", "als", 2)]


def test_zero_max_users_are_reported(spark):
    df = spark.createDataFrame([("u", "s1", 0), ("u", "s2", 0), ("v", "s1", 4)],
                               "user_id string, song_id string, play_count int")
    rej = ratings.normalize_rejects(df).collect()
    assert [(r.user_id, r.n_rows) for r in rej] == [("u", 2)]


def test_segment_stats_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(1, rng.normal(size=64).tolist()), (2, rng.normal(size=24).tolist()), (3, [])]
    df = spark.createDataFrame(rows, "k int, emb array<double>")
    got = {(r.k, r.i, r.j): (r.avg_i, r.cov) for r in arrays.segment_stats(df, "k", "emb", 12).collect()}
    assert len(got) == 2 * 78
    for k, v in rows[:2]:
        cols = [np.array(v[d::12]) for d in range(12)]
        for i in range(12):
            for j in range(i, 12):
                n = min(len(cols[i]), len(cols[j]))
                a, b = cols[i][:n], cols[j][:n]
                assert math.isclose(got[(k, i + 1, j + 1)][0], cols[i].mean())
                assert math.isclose(got[(k, i + 1, j + 1)][1], ((a - a.mean()) * (b - b.mean())).mean(),
                                    abs_tol=1e-12)


def test_impute_uses_declared_bounds(spark):
    df = spark.createDataFrame([(1, None, 3.0), (2, 0.9, None)], "k int, a double, b double")
    got = {r.k: (r.a, r.b) for r in arrays.impute_midrange(df, {"a": (0, 1), "b": (-60, 0)}).collect()}
    assert got == {1: (0.5, 3.0), 2: (0.9, -30.0)}


def test_attributes_use_every_vector(spark, sf):
    from cadenza.sources.tables import read
    n = read(spark, sf, "embeddings").count()
    parts = read(spark, sf, "part").count()
    used = derived.attributes(spark, sf).select("danceability", "energy", "loudness").distinct().count()
    assert used >= 0.99 * min(n, parts)


def test_no_local_fallback_on_a_cluster(spark, monkeypatch):
    import pytest
    from cadenza import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert not session._is_local("local-cluster[2,1,1024]") and session._is_local("local[4]")


def test_scratch_path_keeps_the_scheme(spark):
    from cadenza.session import scratch_path
    assert scratch_path(spark, "x").startswith("file:")


def test_held_out_plays_give_no_similarity(spark, sf):
    plays = derived.plays(spark, sf)
    train, _ = ratings.hash_split(plays, ["user_id", "song_id"], 0.8, 3)
    part = derived.similar(spark, sf, train.select("user_id", "song_id"))
    assert 0 < part.agg(F.sum("score")).first()[0] < derived.similar(spark, sf).agg(F.sum("score")).first()[0]
