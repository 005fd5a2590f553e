"""Joins of a large table to a lookup that has at most one row per key.

Such lookups here are aggregates (one region per LA, the distinct parent keys of a
relationship check). AQE broadcasts them when their measured size is small, which is
the normal case; but AQE's skew-join split does not apply when one side is an
aggregate rather than a plain shuffle, so beyond the broadcast threshold a hot key
(one LA holding a third of all rows) would land in a single task.

``lookup_join`` makes the join skew-proof either way: each large-side row gets a salt
in ``[0, buckets)`` and each lookup row is repeated once per salt, so the join key
``(key, salt)`` spreads a hot key over ``buckets`` tasks, and every large row still
meets exactly the one lookup row of its key. The lookup grows by ``buckets`` rows per
key only.

The salt is a hash of the row's place in storage (Parquet's hidden
``_metadata.file_path`` and ``_metadata.row_index``), so it is the same when a task
is re-run after a lost executor, identical copies of a row spread like any other
rows, and (unlike ``rand`` or ``monotonically_increasing_id``) it is deterministic,
so filters above the join still reach the scan. A large side that is not a direct
file scan (an aggregate, an in-memory frame) is salted by a hash of its contents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 32
_SALT = "__salt"


def row_salt(df: DataFrame, buckets: int) -> Column:
    """A deterministic salt in ``[0, buckets)`` per row of ``df``."""
    try:
        df.select(F.col("_metadata.row_index"))  # resolves only over a file scan
        basis = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    except AnalysisException:
        basis = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(*basis), F.lit(buckets))


def lookup_join(big: DataFrame, lookup: DataFrame, key: str | Sequence[str], how: str = "left",
                buckets: int = SALT_BUCKETS) -> DataFrame:
    """``big.join(lookup, key, how)`` for a lookup unique on ``key``, with hot keys spread.

    ``how`` is one of inner, left, left_semi, left_anti (the large side is the left).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if buckets <= 1:
        return big.join(lookup, keys, how)
    salted = big.withColumn(_SALT, row_salt(big, buckets))
    copies = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))
    return salted.join(copies, keys + [_SALT], how).drop(_SALT)
