"""Layer 1: every SQL-expressible query equals its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from cadenza.sources.tables import DRIVER_TABLES
from tools.check_oracle import digest

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_registered_with_docstring():
    for name, fn in QUERIES.items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "rank", "track_id", "title", "artist_name", "duration",
                          "year", "predicted_score"]
    assert df.count() > 0
