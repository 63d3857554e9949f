import pytest

from chatterscope.session import pin_utc, scratch_path, shared_dir


class Context:
    master = "spark://cluster:7077"


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, conf, master):
        self.conf, self.sparkContext = Conf(conf), Context()
        self.sparkContext.master = master


def test_shared_folder_comes_from_the_session():
    cluster = Session({"spark.checkpoint.dir": "hdfs:///shared/"}, "spark://cluster:7077")
    assert shared_dir(cluster) == "hdfs:///shared/"
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/chatterscope/x-")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(Session({}, "spark://cluster:7077"))


def test_local_sessions_may_use_a_temporary_folder():
    assert "chatterscope" in shared_dir(Session({}, "local[2]"))


def test_pin_utc(spark):
    assert pin_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
