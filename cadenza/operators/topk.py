"""Per-key top-k, rescaling and deterministic de-duplication.

``top_k_per`` is ``row_number() <= k`` over a window, which Spark plans as a
``WindowGroupLimit``: each map task keeps at most k rows per key *before* the
shuffle, so a key holding a third of all rows still sends only k rows per
task.  Rescaling by the per-key maximum is done in a separate step after the
cut (a second window function in the same select would disable the limit);
the maximum of the kept rows is rank 1, so the value is the same.

``dedupe_keep_best`` replaces ``dropDuplicates`` with an ordered survivor via
a ``min(struct)`` aggregate with a map-side combine, so duplicate groups never
have to be buffered whole.  Spark plans it as a sort aggregate, as the
survivor holds strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
              rank_col: str = "rank") -> DataFrame:
    """Keep the first k rows per key under ``order`` (which must end in a
    unique tie-break).  Adds ``rank_col`` (1-based, bigint)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def rescale_by_max(df: DataFrame, keys: Sequence[str], score: str, out: str,
                   scale: float = 10.0) -> DataFrame:
    """out = score * scale / max(score) per key; NULL when max <= 0."""
    w = Window.partitionBy(*_cols(keys))
    mx = F.max(score).over(w)
    return df.withColumn(
        out, F.when(mx > 0, F.try_divide(F.col(score) * F.lit(float(scale)), mx)))


def dedupe_keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]
                     ) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order``.

    ``order`` is a list of (column, 'asc'|'desc'); numeric columns may be
    descending, the last entry should be a unique tie-break.  All other
    columns travel with the survivor.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    parts = []
    for i, (c, direction) in enumerate(order):
        v = F.col(c)
        if direction == "desc":
            v = -v
        parts.append(v.alias(f"_o{i}"))
    payload = [F.col(c).alias(c) for c in rest]
    best = F.min(F.struct(*parts, F.struct(*payload).alias("_row"))).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best._row.{c}").alias(c) for c in rest]).select(
        *df.columns)
