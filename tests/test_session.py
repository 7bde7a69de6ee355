"""Session conventions that protect cluster runs."""

import pytest

from tidewater.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master)
        self.conf = _Conf(conf)


def test_cluster_session_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn", {}))


def test_cluster_session_uses_its_shared_folder():
    s = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_session_gets_a_private_folder_only_when_unset():
    s = _Session("local[2]", {})
    assert ensure_checkpoint_dir(s).startswith("/tmp/run-")
