"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

from apptlake.sources import files

# Keeps streaming state on disk, so that it may outgrow an executor's memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Input bytes per reducer.
BYTES_PER_PARTITION = 256 * 1024 * 1024


def get_session(app_name: str = "apptlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the time zone pinned to UTC and adaptive execution on.

    Keyword arguments are extra settings, with ``__`` standing for a dot.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        # Building a plan takes many small steps; noting the calling line of each costs time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar days and weeks are UTC days and weeks everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """For the jobs within, raise the shuffle partitions to suit the bytes they read; never lower.

    AQE merges small partitions but cannot raise the initial number, so a job over
    terabytes has to start high enough for a partition to fit in executor memory. The session
    is left as it was.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    partitions = max(int(before), -(-input_bytes // BYTES_PER_PARTITION))
    spark.conf.set(setting, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.set(setting, before)


@lru_cache(maxsize=None)
def _local_scratch(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="apptlake-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the cluster.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    files.delete_on_exit(spark, path)
    return path
