import pytest

from shopsignal import session


class _ClusterContext:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class _ClusterSession:
    sparkContext = _ClusterContext()

    class conf:
        @staticmethod
        def get(key, default=None):
            return None


def test_cluster_session_needs_a_shared_checkpoint_dir():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_ClusterSession())


def test_local_session_gets_a_checkpoint_dir(spark):
    root = session.checkpoint_root(spark)
    assert root and session.scratch_path(spark, "x").startswith(root.rstrip("/") + "/")


def test_scratch_scope_names_what_was_drawn_inside(spark):
    import os

    from shopsignal import session

    outside = session.scratch_path(spark, "outside")
    with session.scratch_scope() as drawn:
        inside = [session.scratch_path(spark, n) for n in ("a", "b")]
        for path in (outside, *inside):
            spark.range(3).write.parquet(path)
    assert drawn == inside and session.scratch_path(spark, "later") not in drawn
    session.delete_scratch(spark, drawn)
    here = [os.path.exists(p.removeprefix("file:")) for p in (outside, *inside)]
    assert here == [True, False, False] and spark.read.parquet(outside).count() == 3
    with pytest.raises(ValueError):
        session.delete_scratch(spark, ["/tmp/elsewhere/x"])
