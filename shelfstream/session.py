"""Session settings and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SHARED_DIR = "spark.shelfstream.sharedDir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

STREAM_CONF = {
    # transformWithState keeps its variables in column families, which only RocksDB offers.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Write a changelog per batch instead of a full state upload.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Merge sessions on the map side, so a busy client ships one row per session and task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "shelfstream", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STREAM_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure_streaming(spark: SparkSession) -> None:
    """Apply the settings the stateful operators need to a session somebody else built."""
    for key, value in STREAM_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    ``SHARED_DIR`` names another folder for sessions that were started without one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def computed_once(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder for as long as the block runs.

    For frames that several writes derive from: lost tasks read the table instead of computing again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
