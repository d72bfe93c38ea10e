"""Checkpoint folder policy: shared folder from the session, local scratch only in local mode."""

import pytest

from meterlens.config import DEFAULT_THRESHOLDS, Thresholds, checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf_value=None, ctx_dir=None):
        self.conf, self.sparkContext = _Conf(conf_value), _Ctx(master, ctx_dir)


def test_cluster_uses_the_configured_shared_folder():
    assert checkpoint_dir(_Session("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"
    assert checkpoint_dir(_Session("spark://m:7077", None, "s3a://b/ckpt")) == "s3a://b/ckpt"


def test_cluster_without_setting_refuses_a_local_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("k8s://https://api:443"))


def test_local_mode_gets_private_scratch():
    d = checkpoint_dir(_Session("local[4]"))
    assert d.startswith("/")


def test_thresholds_default_to_reference_values():
    th = DEFAULT_THRESHOLDS
    assert (th.low_consumption_kwh, th.voltage_max_v, th.power_ratio_max, th.night_consumption_kwh,
            th.freq_min_hz, th.freq_max_hz) == (0.30, 245.0, 1.15, 5.0, 49.8, 50.2)
    assert Thresholds(voltage_max_v=250.0).voltage_max_v == 250.0
