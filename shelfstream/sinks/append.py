"""Append-only tables. Each load has a name and a folder of its own: a new name appends, a repeat replaces its own rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfstream.functions.scalars import duration_suffix


def new_load() -> str:
    """A name no other load has."""
    return uuid.uuid4().hex


def append_table(df: DataFrame, path: str, load: str | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Append to the table at ``path``, created if needed."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/load={load or new_load()}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether any load has been written to the table at ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/load=*")
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder))


def raw_rows(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw messages with their processing time and its date for partitioning."""
    now = F.current_timestamp()
    return df.select(now.alias("processed_timestamp"), F.col(value_col).alias("json"), F.to_date(now).alias("date"))


def archive_raw(
    df: DataFrame, path: str, load: str | None = None, value_col: str = "value", test_mode: bool = False
) -> DataFrame:
    """Archive the raw messages by date and hand the input on; does nothing in test mode."""
    if not test_mode:
        append_table(raw_rows(df, value_col), path, load, ("date",))
    return df


def append_failures(spark: SparkSession, path: str, feed: str, counted: Observation, load: str | None = None) -> None:
    """Append what a job's observation counted: rows and parse failures of one load of a feed."""
    found = counted.get
    row = spark.createDataFrame([(found["rows"], found["json_parse_failures"])], "rows long, json_parse_failures long")
    append_table(row, f"{path}/feed={feed}", load)


def aggregate_path(base: str, name: str, duration_ms: int) -> str:
    """Table of an aggregate, e.g. ``base/PageView_5S``."""
    return f"{base.rstrip('/')}/{name}_{duration_suffix(duration_ms)}"


def append_aggregate(df: DataFrame, base: str, name: str, duration_ms: int, load: str | None = None) -> str:
    path = aggregate_path(base, name, duration_ms)
    append_table(df, path, load)
    return path


def stream_load(checkpoint: str) -> str:
    """The load name of a stream: the same for every restart on its checkpoint, another one on another checkpoint."""
    return uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex


def stream_append(df: DataFrame, path: str, checkpoint: str, **trigger):
    """Start an append of a stream to the table at ``path``."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        # A folder beside those of other loads; its own log of files stays below it.
        .option("path", f"{path}/load={stream_load(checkpoint)}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
