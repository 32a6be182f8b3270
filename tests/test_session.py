from __future__ import annotations

from types import SimpleNamespace

import pytest

from sedimenta.session import session_conf, shared_folder

KEY = "spark.sql.files.maxPartitionBytes"


def test_settings_come_back_even_after_a_failure(spark):
    before = spark.conf.get(KEY)
    with pytest.raises(ZeroDivisionError), session_conf(spark, {KEY: "1048576"}):
        assert spark.conf.get(KEY) == "1048576"
        1 / 0
    assert spark.conf.get(KEY) == before
    assert spark.conf.get(KEY, None) is None


def test_a_value_set_by_the_user_comes_back(spark):
    spark.conf.set(KEY, "2097152")
    try:
        with session_conf(spark, {KEY: "1048576"}):
            pass
        assert spark.conf.get(KEY) == "2097152"
    finally:
        spark.conf.unset(KEY)


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_follows_the_cluster():
    named = session("yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(named, "lake").startswith("hdfs:///shared/lake-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"), "lake")
    assert "lake-" in shared_folder(session("local[2]"), "lake")
