"""Id expressions.

The source hashes string ids to 28 bits with the process-randomised Python
``hash``, which cannot serve as a stored id.  ``stable_hash28`` keeps the
width (so ids fit ALS's int32) but is deterministic and identical in Spark
and DuckDB: the first 7 hex digits of md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 28  # fixed: 7 hex digits


def stable_hash28(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 7), 16, 10).cast("bigint")


def hash_bucket(*cols: Column | str, seed: int = 0) -> Column:
    """Deterministic bucket in [0, 2^28) of a row key, for splits."""
    parts = [F.lit(str(seed))] + [F.coalesce((F.col(c) if isinstance(c, str) else c)
                                             .cast("string"), F.lit("\u0000")) for c in cols]
    return stable_hash28(F.concat_ws("|", *parts))
