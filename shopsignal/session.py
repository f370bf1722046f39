"""Session helpers for tests, the bench and the CLI.

Library jobs never create a session; callers pass one.  ``scratch_path`` gives
jobs that must materialise an intermediate (round trips, lineage cuts) a place
in the *shared* checkpoint folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) do we create our own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests / local runs (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.master(master).appName("shopsignal")
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, the bench) without that setting gets a
    temporary folder of its own; on a cluster a machine-local folder would not
    be shared by the executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage (e.g. HDFS or an object "
                "store) that every executor can read and write"
            )
        configured = tempfile.mkdtemp(prefix="shopsignal-ckpt-")  # local/test sessions only
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/shopsignal-scratch/{spark.sparkContext.applicationId}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The scratch paths drawn inside, in order, so that a job can delete its own when their results are written elsewhere."""
    drawn: list[str] = []
    _SCOPES.append(drawn)
    try:
        yield drawn
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not drawn]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    What is written there backs lazy results, so it has to stay until they are
    used: ``delete_scratch`` deletes single paths, ``remove_scratch`` all of an application's scratch data.
    """
    path = f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"
    for drawn in _SCOPES:
        drawn.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def delete_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch paths of this application (each in the folder of its own that ``scratch_path`` gave it)."""
    root = _scratch_root(spark)
    for path in paths:
        if not path.startswith(f"{root}/"):
            raise ValueError(f"{path} is not scratch data of this application")
        _delete(spark, path.rsplit("/", 1)[0])


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch data; results not yet written elsewhere are lost with it."""
    _delete(spark, _scratch_root(spark))
