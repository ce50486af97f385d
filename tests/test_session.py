"""Checkpoint-folder policy: read from the session; a temp folder only for
a local session without one; a cluster session without one is an error."""

import pathlib
import re

import pytest

from behavio.session import checkpoint_dir


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self.set_to = master, ckpt, None

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self.set_to = self._ckpt = d


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, k, default=None):
        return self.values.get(k, default)


class _Spark:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext = _SC(master, ckpt)
        self.conf = _Conf(conf or {})


def test_session_setting_is_used():
    s = _Spark("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"
    s = _Spark("yarn", ckpt="s3a://bucket/ckpt")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt" and s.sparkContext.set_to is None


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Spark("yarn"))


def test_local_without_setting_gets_temp_folder():
    s = _Spark("local[4]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.set_to == d


def test_no_test_module_imports_a_conftest():
    """Both test folders have a conftest; by name, either could be meant."""
    here = pathlib.Path(__file__).parent
    found = [p.name for p in here.rglob("test_*.py") if re.search(r"^\s*(from|import) conftest\b", p.read_text(), re.M)]
    assert not found
