
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_robin(df: DataFrame, n_partitions: int | None) -> DataFrame:
    """L1: round-robin repartition to ``n_partitions`` (None = leave to AQE)."""
    return df if not n_partitions else df.repartition(n_partitions)


def by_key(df: DataFrame, key: str, n_partitions: int | None = None) -> DataFrame:
    """L2: hash repartition on ``key`` so each key lives in one partition."""
    return df.repartition(n_partitions, key) if n_partitions else df.repartition(key)


def by_id(df: DataFrame, partition: Column, n_partitions: int) -> DataFrame:
    """L2 with the partition given as an expression: row ``r`` goes to partition ``partition(r) mod n_partitions``."""
    return df.repartitionById(n_partitions, partition.cast("int"))


def clustered(df: DataFrame, key: str, n_partitions: int | None = None, then: str | Sequence[str | Column] | None = None) -> DataFrame:
    """Q7: range-partition and sort on ``key`` so Parquet min/max stats prune lookups.

    ``then`` are further range columns for a key that may be hot: ranges over
    ``(key, *then)`` cut one key holding a third of all rows into many
    partitions (and files), while every file still covers one contiguous
    stretch of ``key``, so min/max pruning on ``key`` is unchanged.  With an
    order in ``then`` (``F.col("score").desc()``) a key's first rows are in its first file.
    """
    more = [] if then is None else [then] if isinstance(then, str) else list(then)
    cols = [key, *more]
    ranged = df.repartitionByRange(n_partitions, *cols) if n_partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def partition_sizes(df: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Rows of each partition as ``(partition, rows)``, empty ones included.

    The partitions are those of ``df``'s own plan; ``n_partitions`` only says how many
    are listed at least.  Without it their number is read from the plan (a
    shuffle in it runs for that).  A partition beyond the number given is
    reported all the same, so the rows always add up to those of ``df``.
    """
    n = df.rdd.getNumPartitions() if n_partitions is None else n_partitions
    rows = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return every.join(rows, "partition", "full").select("partition", F.coalesce("rows", F.lit(0)).alias("rows"))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` only when its scan has fewer splits than the cluster has cores.

    Under-split inputs (one unsplittable file, a multi-line CSV, a single
    Parquet row group) would otherwise run all per-row parsing in a few tasks.
    Inputs that already have enough splits, as at scale, are returned as is,
    so this never adds a shuffle to a large scan.  Only for plain scans: the
    number of partitions of a plan with a shuffle is known only by running it.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
