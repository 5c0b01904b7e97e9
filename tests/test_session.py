"""Checkpoint-folder rules: the session's setting wins; a scratch folder only
on a local master; an unset setting on a cluster is an error."""

import pytest

from mercato.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, conf or {})


def test_cluster_setting_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_unset_on_cluster_is_an_error():
    s = _Session("spark://head:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(s)
    assert s.sparkContext.dir is None


def test_unset_on_local_master_gets_scratch_folder():
    s = _Session("local[4]")
    path = ensure_checkpoint_dir(s)
    assert path and "mercato-ckpt-" in path
    assert ensure_checkpoint_dir(s) == path  # set once, then reused


def test_scratch_tables_can_be_dropped(spark, monkeypatch):
    import os

    from mercato import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    a, b = (session.scratch_path(spark, x) for x in ("one", "two"))
    for p in (a, b):
        spark.range(3).write.parquet(p)
    local = lambda p: p.removeprefix("file:")
    assert session.drop_scratch(spark, keep=(b,)) == 1
    assert not os.path.exists(local(a)) and spark.read.parquet(b).count() == 3
    assert session.drop_scratch(spark) == 1 and not os.path.exists(local(b))
