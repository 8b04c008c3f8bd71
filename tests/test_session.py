from types import SimpleNamespace

import pytest

from flowgauge.session import SESSION_SETTINGS, ensure_checkpoint_dir


class Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def session(master, current=None, **conf):
    get = lambda key, default: conf.get(key.replace(".", "_"), default)
    return SimpleNamespace(sparkContext=Context(master, current), conf=SimpleNamespace(get=get))


def test_the_session_has_the_library_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in SESSION_SETTINGS.items())


def test_the_cluster_folder_wins():
    assert ensure_checkpoint_dir(session("yarn", "hdfs://a")) == "hdfs://a"
    named = session("yarn", spark_checkpoint_dir="hdfs://b")
    assert ensure_checkpoint_dir(named) == named.sparkContext.current == "hdfs://b"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session("spark://host:7077"))


def test_a_local_session_may_use_a_temporary_folder():
    local = session("local[4]")
    assert ensure_checkpoint_dir(local) == local.sparkContext.current
