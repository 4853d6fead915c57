"""The checkpoint-folder rule, on stand-in session objects."""

import pytest

from farebox import session as SE


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf({})


def test_cluster_session_without_folder_is_refused():
    with pytest.raises(RuntimeError):
        SE.ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_session_uses_the_named_folder():
    s = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert SE.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert SE.scratch_path(s, "typed-trips").startswith("hdfs:///shared/ckpt/typed-trips-")


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    d = SE.ensure_checkpoint_dir(s)
    assert d and s.sparkContext.getCheckpointDir() == d
    assert SE.scratch_path(s, "x") != SE.scratch_path(s, "x")  # a fresh folder each time
