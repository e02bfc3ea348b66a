"""Cluster-safety rules of the checkpoint and output folders."""

import pytest

from starloom.plans import publish
from starloom.session import checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf=None):
        self.master = master
        self._dir = None
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Runtime(_Conf):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, master, conf=None, session_conf=None):
        self.sparkContext = _Context(master, conf)
        self.conf = _Runtime(session_conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("spark://cluster:7077"))


def test_configured_checkpoint_dir_is_used():
    s = _Session("spark://cluster:7077", conf={"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://shared/ckpt"
    s = _Session("yarn", session_conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_local_session_gets_scratch_only_when_unset():
    s = _Session("local[4]")
    d = checkpoint_dir(s)
    assert d and checkpoint_dir(s) == d  # set once, then reused


def test_output_root_is_configured_on_a_cluster():
    s = _Session("spark://cluster:7077", session_conf={publish.OUTPUT_CONF: "hdfs://shared/wh/"})
    assert publish.output_root(s) == "hdfs://shared/wh"
    s = _Session("spark://cluster:7077", session_conf={"spark.sql.warehouse.dir": "/local/warehouse"})
    with pytest.raises(RuntimeError, match="shared folder"):
        publish.output_root(s)


@pytest.mark.parametrize("master", ["spark://cluster:7077", "local-cluster[3,2,3000]"])
def test_output_root_on_a_cluster_falls_back_to_the_shared_folder(master):
    s = _Session(master, conf={"spark.checkpoint.dir": "hdfs://shared/ckpt/"})
    root = publish.output_root(s)
    assert root.startswith("hdfs://shared/ckpt/out-") and publish.output_root(s) == root
    with pytest.raises(RuntimeError, match="shared folder"):
        publish.output_root(_Session(master))


def test_output_root_follows_the_shared_folder():
    """A remembered folder would lie below a checkpoint folder that is no longer shared."""
    s = _Session("local-cluster[3,2,3000]", conf={"spark.checkpoint.dir": "hdfs://shared/one"})
    assert publish.output_root(s).startswith("hdfs://shared/one/out-")
    s.sparkContext.setCheckpointDir("hdfs://shared/two")
    assert publish.output_root(s).startswith("hdfs://shared/two/out-")
    s.conf.set(publish.OUTPUT_CONF, "hdfs://shared/wh")
    assert publish.output_root(s) == "hdfs://shared/wh"
