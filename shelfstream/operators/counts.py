"""Counts per fixed time window. The same functions run on batch and on streaming frames.

Input needs an ``event_time`` timestamp column (see :func:`with_event_time`); on a stream it must
carry the watermark. Every count keeps its ``window`` column, so a second count can be stacked on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_WINDOW_MS = 5_000


def with_event_time(df: DataFrame, millis_col: str = "timestamp", watermark: str | None = None) -> DataFrame:
    """Event time from an epoch-millisecond column; ``watermark`` is the allowed delay on a stream."""
    timed = df.withColumn("event_time", F.timestamp_millis(F.col(millis_col)))
    return timed.withWatermark("event_time", watermark) if watermark else timed


def with_fixed_window(df: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Add the fixed ``window`` each row falls into."""
    return df.withColumn("window", F.window("event_time", f"{duration_ms} milliseconds"))


def window_metadata(counts: DataFrame, duration_ms: int) -> DataFrame:
    return counts.withColumn("durationMS", F.lit(duration_ms).cast("bigint")).withColumn(
        "startTime", F.unix_millis("window.start")
    )


def _windowed_count(df: DataFrame, duration_ms: int, *keys: str) -> DataFrame:
    span = F.window("event_time", f"{duration_ms} milliseconds")
    return df.groupBy(span, *keys).agg(F.count(F.lit(1)).alias("count"))


def _no_metadata(counts: DataFrame) -> DataFrame:
    empty = F.lit(None).cast("bigint")
    return counts.withColumn("durationMS", empty).withColumn("startTime", empty)


def page_views(df: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Browse events per page and window."""
    browse = F.col("event") == "browse"
    if df.isStreaming:
        # Naming the time column keeps the filter above the watermark, which all events advance.
        browse = F.when(F.col("event_time").isNotNull(), browse)
    return window_metadata(_windowed_count(df.filter(browse), duration_ms, "page"), duration_ms)


def stock_counts(df: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Stock messages per product, store and window."""
    return window_metadata(_windowed_count(df, duration_ms, "product_id", "store_id"), duration_ms)


def transaction_counts(df: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Transactions per product, store and window; the two time fields stay null."""
    return _no_metadata(_windowed_count(df, duration_ms, "product_id", "store_id"))


def _rows_per_product(counts: DataFrame, duration_ms: int) -> DataFrame:
    per_product = counts.groupBy("window", "product_id").agg(F.count(F.lit(1)).alias("count"))
    return window_metadata(per_product.withColumn("store_id", F.lit(None).cast("int")), duration_ms)


def global_stock_updates(counts: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Number of :func:`stock_counts` rows per product and window (rows, not units)."""
    return _rows_per_product(counts, duration_ms)


def global_stock_from_transactions(counts: DataFrame, duration_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Number of :func:`transaction_counts` rows per product and window."""
    return _rows_per_product(counts, duration_ms)
