"""Partition sizing and small helpers."""

from affinity.__main__ import _strengths
from affinity.session import scale_conf


def test_scale_conf_for_100_tb():
    conf = scale_conf(100e12, 1000, 8)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 150_000 <= parts <= 250_000
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 * 1024**2


def test_scale_conf_small_input_fills_slots_once():
    conf = scale_conf(40e6, 1, 8)
    assert conf["spark.sql.shuffle.partitions"] == "8"
    assert int(conf["spark.sql.files.maxPartitionBytes"]) >= 16 * 1024**2


def test_strength_pairs_parse():
    assert _strengths("0:0,0.01:1") == [(0.0, 0.0), (0.01, 1.0)]
    assert _strengths(None) is None
