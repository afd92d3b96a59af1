"""Checkpoint folder rule: the cluster's shared folder, a temporary one only locally."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from opsfold.config import checkpoint_dir


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self._dir = current
        self.set_to = None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self.set_to = self._dir = path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def _session(master, current=None, conf=None):
    return SimpleNamespace(sparkContext=_Context(master, current), conf=_Conf(conf or {}))


def test_uses_the_context_folder_first():
    s = _session("yarn", current="hdfs:///shared/ckpt")
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_uses_the_configured_folder():
    s = _session("k8s://cluster", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.set_to == "s3a://bucket/ckpt"


def test_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_session("yarn"))


def test_local_master_gets_a_temporary_folder():
    s = _session("local[4]")
    path = checkpoint_dir(s)
    assert path and s.sparkContext.set_to == path
    assert s.conf.get("spark.checkpoint.dir") == path
