"""Unpacking a long packed list is linear in its length."""

from __future__ import annotations

import time

from cadenza.functions.packed import unpack_pairs


def test_unpacking_is_linear_in_the_list(spark):
    """One split a list: a list of 20,000 entries takes no minutes."""
    n = 20_000
    df = spark.createDataFrame([("t", ",".join(f"id{k}, {k}.5" for k in range(n)) + ",tail"), ("u", "a"), ("v", None)],
                               "tid string, target string")
    begin = time.time()
    rows = unpack_pairs(df).collect()
    assert time.time() - begin < 15
    assert [(r.tid, r.target, r.score) for r in rows] == [("t", f"id{k}", k + 0.5) for k in range(n)]
