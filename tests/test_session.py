"""The shared work folder rule."""

import pytest

from ledgerline.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.set_to = path
        self.current = path


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used_and_local_mode_gets_one():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert checkpoint_dir(_Session("yarn", current="hdfs://nn/ckpt/abc")) == "hdfs://nn/ckpt/abc"
    local = _Session("local[4]")
    assert checkpoint_dir(local) == local.sparkContext.set_to
