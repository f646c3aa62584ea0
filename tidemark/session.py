"""Sessions and session settings."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Only what the jobs need to differ from Spark's defaults; sizing is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# State store for queries whose state can outgrow the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What all state partitions on an executor share: write buffers, cached blocks, indexes and filters.
STATE_MEMORY_MB = 256


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the length of a block. Dots are written as double underscores."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def state_store(spark: SparkSession) -> dict[str, str]:
    """Settings for state in RocksDB, of bounded memory; the session's own bound goes first.

    Without them every open partition has a cache and buffers of its own, and tables' indexes outside of these.
    """
    prefix = "spark.sql.streaming.stateStore"
    bound = {f"{prefix}.rocksdb.boundedMemoryUsage": "true", f"{prefix}.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB)}
    return {f"{prefix}.providerClass": ROCKSDB} | {name: spark.conf.get(name, value) for name, value in bound.items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local one only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
