"""Cluster settings sized from the input, applied only where the session has none.

Partitions are sized so a shuffle partition and a scan split stay well inside
an executor task's memory at any input size; AQE then coalesces small
partitions (to the advisory size, not to maximal parallelism) and splits
skewed ones at run time.

Automatic broadcasts are decided from measured sizes only: the static
planner's threshold is off (its estimate comes from compressed file sizes,
which can be many times smaller than the rows in memory), and AQE broadcasts
a join side once its shuffle output is measured below
``RUNTIME_BROADCAST_BYTES``.  Explicit ``broadcast()`` hints (behind a
measured row count and size, ``plans.joins.checked_broadcast``) are unaffected.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 512 * 1024 * 1024  # per shuffle partition, before AQE coalesces or splits
SCAN_SPLIT_BYTES = 512 * 1024 * 1024  # the most a scan task reads
SMALL_SPLIT_BYTES = 128 * 1024 * 1024  # scan split of inputs that would otherwise have too few tasks
MIN_SHUFFLE_PARTITIONS = 200
# In-memory bytes of shuffled rows for a byte of compressed input: the jobs shuffle a few short columns, mostly after
# partial sums, never the metadata texts that make up most of a log row.
SHUFFLED_SHARE = 0.25
RUNTIME_BROADCAST_BYTES = 64 * 1024 * 1024  # measured shuffle output of a side AQE may broadcast


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FileSystem; works for any supported store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def recommended(total_input_bytes: int, shuffled_share: float = SHUFFLED_SHARE) -> dict[str, str]:
    """Settings for jobs reading ``total_input_bytes`` of compressed columnar input; no cap at any size.

    Fewer, larger tasks at scale: an exchange has (map tasks x partitions)
    blocks, so both grow only with the bytes they really hold.
    """
    shuffle_bytes = max(1, int(total_input_bytes * shuffled_share))
    partitions = max(MIN_SHUFFLE_PARTITIONS, math.ceil(shuffle_bytes / TARGET_PARTITION_BYTES))
    split = SCAN_SPLIT_BYTES if total_input_bytes >= 1000 * SCAN_SPLIT_BYTES else SMALL_SPLIT_BYTES
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(RUNTIME_BROADCAST_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES // 4),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def apply_missing(spark: SparkSession, settings: dict[str, str]) -> dict[str, str]:
    """Set each setting the user has not set explicitly; returns what was applied."""
    applied = {}
    user_set = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in settings.items():
        if key not in user_set:
            spark.conf.set(key, value)
            applied[key] = value
    return applied
