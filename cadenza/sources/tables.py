"""Driver-table access.

Every query reads its inputs through :func:`read`, which is a plain
``spark.read.parquet``: Catalyst prunes the columns each plan needs and pushes
filters into the scan, so no column list is fixed here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.session import table_path

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
