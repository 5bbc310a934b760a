"""The shared folder comes from spark.checkpoint.dir; a local one is chosen only when it is unset."""

import os

from paddock import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    master = "local[4]"

    def __init__(self, values, ckpt=None):
        self._conf = _Conf(values)
        self.ckpt = ckpt

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Spark:
    def __init__(self, values, ckpt=None):
        self.conf = _Conf(values)
        self.sparkContext = _Context(values, ckpt)


def test_cluster_setting_wins():
    s = _Spark({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert session.checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/paddock/x-")
    assert s.sparkContext.ckpt is None          # nothing set behind the cluster's back


def test_local_folder_only_when_unset():
    s = _Spark({})
    root = session.checkpoint_root(s)
    assert os.path.isdir(root) and s.sparkContext.ckpt == root
    assert session.checkpoint_root(s) == root   # chosen once per session
