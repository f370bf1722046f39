"""Join strategy helpers.

Two ways a join side gets broadcast, both behind a size that was measured:

* ``checked_broadcast``: the side's rows and bytes are measured first;
  beyond either bound the side is returned unchanged and Catalyst plans a
  shuffle join.
* Aggregated sides (one row per key) are left to AQE, which broadcasts a
  side only from the measured size of its shuffle output
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise keeps the
  sort-merge join, splitting hot keys of the other side.  For that split the
  aggregate is grouped with ``key_bucket`` (see there).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if both its measured row count and its measured
# size (``row_bytes``) are within these bounds.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Buckets of ``key_bucket``; any value > 1 works, it only changes the grouping columns.
KEY_BUCKETS = 64


def key_bucket(*keys: str) -> Column:
    """A redundant grouping column for an aggregate that later feeds a join on ``keys``.

    The value is a function of ``keys`` alone, so ``groupBy(*keys,
    key_bucket(*keys))`` forms exactly the groups of ``groupBy(*keys)``.  But
    the aggregate's output is then hash-partitioned on more columns than the
    join keys, so the join adds its own shuffle on ``keys`` directly under its
    sort.  That is the shape AQE's skew-join rule needs to split a hot key on
    the *other* side, and the shuffle's measured size lets AQE broadcast this
    side when it is small.  Without it the join reads the aggregate's
    partitioning as is, and one task gets every row of a hot key.
    """
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_BUCKETS)).alias("_key_bucket")


def row_bytes(df: DataFrame) -> Column:
    """An upper-bound estimate of one row's in-memory size in bytes.

    A 16-byte row header, an 8-byte slot per field, plus the UTF-8 bytes of
    every string or binary value (and the JSON text of nested values), so the
    sum over a side measures what a broadcast would ship, however long its
    strings turn out to be.
    """
    parts = [F.lit(16)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8)
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts).cast("long")


def _size_aggregates(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")]


def broadcastable(rows: int, nbytes: int, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether a side with the measured ``rows`` and ``nbytes`` may be broadcast (``max_rows`` None/0: never)."""
    return bool(max_rows) and max_rows > 0 and rows <= max_rows and nbytes <= max_bytes


def checked_broadcast(
    df: DataFrame,
    max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` measures at most ``max_rows`` rows and ``max_bytes`` bytes, else ``df``.

    The measurement is one distributed aggregate (partial sums per task, no
    rows move).
    """
    if not max_rows:
        return df
    got = df.agg(*_size_aggregates(df)).first()
    return F.broadcast(df) if broadcastable(int(got["rows"]), int(got["bytes"]), max_rows, max_bytes) else df
