from __future__ import annotations

from types import SimpleNamespace

import pytest

from tutorlake.session import fresh_dir, shared_dir, stream_session


def fake(master, **conf):
    settings = SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))


def test_the_named_folder_is_used():
    assert shared_dir(fake("yarn", spark_checkpoint_dir="hdfs:///work")) == "hdfs:///work"
    assert shared_dir(fake("local[2]", spark_checkpoint_dir="/shared")) == "/shared"


def test_only_local_masters_fall_back_to_a_temporary_folder():
    assert shared_dir(fake("local[2]")) == shared_dir(fake("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("spark://host:7077"))


def test_fresh_folders_differ(spark):
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")


def test_stream_sessions_have_their_own_settings(spark):
    sibling = stream_session(spark, state_partitions=7)
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert sibling.sparkContext is spark.sparkContext
