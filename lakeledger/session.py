"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings this library relies on; everything else is left to the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "lakeledger", extra_conf: dict | None = None) -> SparkSession:
    """A session for tests, benchmarks and local runs (clusters pass their own)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # One JVM: a "distributed" file listing only adds a job per scan of a
        # table with many date folders. Cluster sessions keep Spark's default.
        builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    builder = builder.config("spark.driver.memory", os.environ.get("LAKELEDGER_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here;
    a cluster session without it is an error. Only a local session (tests,
    benchmarks) gets a private folder created and set.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3A, ABFS, ...): "
                               "scratch tables and stream checkpoints are kept there")
        current = tempfile.mkdtemp(prefix="lakeledger-ckpt-")
        sc.setCheckpointDir(current)
    return str(current).rstrip("/")


#: Whether a session's queries give up their shuffle files as they end; read when a query begins.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_INSIDE: dict[int, list] = {}  # of each JVM session: how many are inside, and the setting before
_INSIDE_LOCK = threading.Lock()


@contextmanager
def shuffles_end(spark: SparkSession):
    """Queries that begin inside give up their shuffle files when they end.

    Otherwise the files of every write stay on the executors' disks until the driver happens to collect garbage, and a job of
    many writes holds those of all of them at once. Only for queries that are run once: a frame that is run again
    would shuffle again. The setting is the session's, so threads that are inside together share it, and the last one out puts it back.
    """
    session = spark._jsparkSession.hashCode()
    with _INSIDE_LOCK:
        if session not in _INSIDE:
            _INSIDE[session] = [0, spark.conf.get(SHUFFLES_END, None)]
            spark.conf.set(SHUFFLES_END, "true")
        _INSIDE[session][0] += 1
    try:
        yield
    finally:
        with _INSIDE_LOCK:
            _INSIDE[session][0] -= 1
            if not _INSIDE[session][0]:
                before = _INSIDE.pop(session)[1]
                spark.conf.unset(SHUFFLES_END) if before is None else spark.conf.set(SHUFFLES_END, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/lakeledger/{label}-{uuid.uuid4().hex[:12]}"
