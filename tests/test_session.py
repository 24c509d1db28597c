"""Where scratch tables and stream checkpoints go, and how long shuffle files stay."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest

from lakeledger.session import SHUFFLES_END, checkpoint_root, scratch_dir, shuffles_end
from lakeledger.sources import tables


def _fake_session(master, conf_dir=None, ctx_dir=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: ctx_dir,
                         setCheckpointDir=lambda d: None)
    conf = SimpleNamespace(get=lambda key, default=None: conf_dir or default)
    return SimpleNamespace(sparkContext=sc, conf=conf)


def test_cluster_session_uses_the_shared_folder():
    s = _fake_session("yarn", conf_dir="hdfs://nn/checkpoints/")
    assert checkpoint_root(s) == "hdfs://nn/checkpoints"
    a, b = scratch_dir(s, "q"), scratch_dir(s, "q")
    assert a.startswith("hdfs://nn/checkpoints/lakeledger/q-") and a != b


def test_cluster_session_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_fake_session("k8s://https://api:443"))


def test_local_session_without_a_folder_gets_a_private_one():
    assert checkpoint_root(_fake_session("local[2]")).startswith("/")


def _shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "date_add(DATE'2025-09-01', CAST(id % 7 AS INT)) AS d")
    kept = _shuffle_files(spark)
    tables.create_table(spark, str(tmp_path / "t"), rows, "d")  # dealt out by date: a shuffle
    until = time.time() + 10
    while _shuffle_files(spark) - kept and time.time() < until:
        time.sleep(0.1)  # files are removed in the background
    assert not _shuffle_files(spark) - kept
    assert tables.scan_table(spark, str(tmp_path / "t")).count() == 2000


def test_the_setting_holds_until_the_last_thread_is_out_and_is_put_back(spark):
    assert spark.conf.get(SHUFFLES_END, None) is None

    def inside(seconds):
        with shuffles_end(spark):
            time.sleep(seconds)
            return spark.conf.get(SHUFFLES_END)
    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(inside, (0, 0.1, 0.4))) == ["true"] * 3
    assert spark.conf.get(SHUFFLES_END, None) is None
    spark.conf.set(SHUFFLES_END, "false")
    try:
        with pytest.raises(ValueError), shuffles_end(spark):
            raise ValueError
        assert spark.conf.get(SHUFFLES_END, None) == "false"
    finally:
        spark.conf.unset(SHUFFLES_END)
