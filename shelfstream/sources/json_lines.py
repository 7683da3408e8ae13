"""JSON messages as strings in ``value``, from files or as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


#: Bytes that a micro-batch takes from a folder unless it is told otherwise.
ADMITTED = "1g"


def stream_json_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = ADMITTED
) -> DataFrame:
    """Files arriving in ``path``. Every operator takes any other streaming frame with ``value`` as well.

    A micro-batch takes files up to ``max_bytes_per_trigger``, one at least, or ``max_files_per_trigger`` files if that is given.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path)


def split_attribute(lines: DataFrame, name: str = "TIMESTAMP", separator: str = "\t") -> DataFrame:
    """Messages whose lines begin with an attribute: ``<attribute><separator><message>`` becomes two columns.

    A line without the separator is a message without the attribute.
    """
    at = F.instr("value", separator)
    message = F.when(at > 0, F.expr(f"substring(value, {len(separator)} + instr(value, '{separator}'))")).otherwise(F.col("value"))
    attribute = F.when(at > 0, F.substring_index("value", separator, 1))
    return lines.select(*[c for c in lines.columns if c != "value"], attribute.alias(name), message.alias("value"))


def assign_event_time(df: DataFrame, millis_col: str = "TIMESTAMP", watermark: str | None = None) -> DataFrame:
    """Event time from a message attribute in epoch milliseconds (number or text)."""
    timed = df.withColumn("event_time", F.timestamp_millis(F.col(millis_col).try_cast("bigint")))
    return timed.withWatermark("event_time", watermark) if watermark else timed


def read_store_locations(spark: SparkSession, path: str) -> DataFrame:
    """The store dimension from its parquet table."""
    from shelfstream.operators.enrich import store_dimension

    return store_dimension(spark.read.parquet(path))
