"""Plan-shape guards for the scale properties the README claims."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

Q = entry.queries()
# the text operators have tests and plans of their own
OWN = set(Q) & set(__import__("cadenza.registry", fromlist=["x"]).QUERIES)
# spark.ml scores with its own UDFs (Scala, inside the plan) and its model
# selection queries return tables of results; the rest of the plan is checked
MODEL = {n for n in OWN if n.startswith(("als_grid", "als_lambda", "als_model", "content_eval"))}
REQUESTS = {"als_implicit_topk", "als_hash_ids_topk", "als_list_shape", "hybrid_all_users", "hybrid_topk",
            "content_new_releases", "content_new_releases_requested", "recall_by_method"}
# the catalogue meets a model of each requested user in one pass of Arrow batches
MODELS = {"hybrid_all_users", "content_new_releases_requested", "recall_by_method", "als_topk_norm_bounds"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(OWN - MODEL))
def test_no_cross_products_or_python(spark, sf, name):
    plan = _plan(Q[name](spark, sf))
    # a stated request table against all items, in spark.ml's factor blocks
    allowed = {"CartesianProduct", "BroadcastNestedLoopJoin"} if name in REQUESTS else set()
    allowed |= {"MapInPandas"} if name in MODELS else set()
    assert not [k for k in FORBIDDEN if k in plan and k not in allowed], name


def test_flagship_limits_before_user_shuffle(spark, sf):
    plan = _plan(Q["similar_items_topk"](spark, sf))
    # a partial WindowGroupLimit feeds the exchange that groups by user
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+, \d+\)[^\n]*\n[^\n]*"
                     r"WindowGroupLimit", plan), plan[:3000]


def test_scans_are_pruned(spark, sf):
    plan = _plan(Q["similar_items_topk"](spark, sf))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for s in schemas:
        assert len(s.split(",")) <= 5, s


def test_only_bounded_broadcast_hints(spark, sf):
    # the one explicit broadcast is the per-partition offset table
    import inspect
    import cadenza
    import pkgutil
    hits = []
    for m in pkgutil.walk_packages(cadenza.__path__, "cadenza."):
        if m.name.startswith("cadenza.llm"):
            continue
        src = inspect.getsource(__import__(m.name, fromlist=["x"]))
        hits += [m.name for _ in re.finditer(r"F\.broadcast\(", src)]
    assert hits == ["cadenza.operators.ids"]


@pytest.mark.parametrize("name", ["norm_by_user_max", "norm_min_max", "positive_scores",
                                  "score_class", "user_profile", "user_cosine",
                                  "dataset_profile"])
def test_per_user_statistics_use_aggregates_not_windows(spark, sf, name):
    plan = _plan(Q[name](spark, sf))
    assert "Window" not in plan.replace("WindowGroupLimit", ""), name


@pytest.mark.parametrize("name", ["genre_logit", "genre_tree", "genre_naive_bayes"])
def test_models_read_no_catalogue(spark, sf, name):
    assert "p_brand" not in _plan(Q[name](spark, sf)) and "part.parquet" not in _plan(Q[name](spark, sf))


def test_bag_difference_combines_the_right_side(spark, sf):
    plan = _plan(Q["bag_difference"](spark, sf))
    assert plan.count("HashAggregate") >= 4, plan


def test_first_records_need_no_shuffle(spark, sf):
    from cadenza.session import scratch_path
    from cadenza.sources import files
    root = files.write_song_files(spark, sf, scratch_path(spark, "song_files"))
    df = spark.read.option("recursiveFileLookup", "true").parquet(root)
    assert "Exchange" not in _plan(df.where("_metadata.row_index = 0"))
