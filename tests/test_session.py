"""The shared folder comes from the session; only local sessions may fall
back to a private folder."""

import pytest

from martlet.session import shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    """Stand-in with the two things shared_dir reads (no SparkContext, as
    under Spark Connect)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_configured_folder_is_used_as_is():
    s = _Session({"spark.checkpoint.dir": "hdfs://shared/ckpt/", "spark.master": "yarn"})
    assert shared_dir(s) == "hdfs://shared/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session({"spark.master": "yarn"}))


def test_local_session_gets_a_private_folder():
    s = _Session({"spark.master": "local[8]"})
    d = shared_dir(s)
    assert d and shared_dir(s) == d
