import pytest

from recprep.session import ensure_checkpoint_dir
from recprep.sources.tfrecord import store


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self.set_to = master, ckpt, None

    def getCheckpointDir(self):
        return self._ckpt

    def getConf(self):
        return _Conf()

    def setCheckpointDir(self, d):
        self.set_to = self._ckpt = d


class _Spark:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _SC(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_configured_checkpoint_dir_is_used_on_a_cluster():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ck"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ck"


def test_local_master_gets_a_private_folder():
    s = _Spark("local[2]")
    assert ensure_checkpoint_dir(s).startswith("/")


def test_tfrecord_paths_resolve_as_spark_does():
    assert store("file:/tmp/x")[1] == "/tmp/x"
    assert store("file:///tmp/x")[1] == "/tmp/x"
    assert store("/tmp/x", "file:///")[1] == "/tmp/x"
    with pytest.raises(Exception):               # no such scheme here, and no silent local file
        store("/tmp/x", "nostore://nn")
