"""Folders for intermediate tables."""

import os

import pytest

from scholarlake.sinks import scratch


def test_new_folders_lie_in_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (scratch.new_folder(spark, "x") for _ in range(2))
    assert first != second and os.path.dirname(first) == os.path.dirname(second) == shared
    spark.range(3).write.parquet(first)
    scratch.remove(spark, first)
    assert not os.path.exists(first)


class Session:
    """As much of a session as is asked for."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.set_to = None

    def get(self, key, default):
        return self.set_to

    def set(self, key, value):
        self.set_to = value


def test_a_temporary_folder_only_without_a_cluster():
    local = Session("local[4]")
    folder = scratch.shared_folder(local)
    assert os.path.isdir(folder) and scratch.shared_folder(local) == folder
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_folder(Session(master))
