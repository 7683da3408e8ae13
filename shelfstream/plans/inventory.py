"""The whole inventory job: three feeds, one event type, on-hand counts and velocity signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfstream.config import RetailConfig
from shelfstream.operators.inventory import KEYS, inventory_batch
from shelfstream.operators.unify import unify_clickstream, unify_stock, unify_transactions, union_events
from shelfstream.operators.velocity import velocity_batch
from shelfstream.session import computed_once
from shelfstream.sinks.serving import format_signal_kv, format_stock_kv, latest_per_key, upsert_latest
from shelfstream.sources.json_lines import read_json_lines
from shelfstream.streaming.inventory_state import inventory_stream
from shelfstream.streaming.runs import start_batches
from shelfstream.streaming.velocity_state import velocity_stream

# Files carry no arrival order of their own, so events are taken in the order of their times. With the key these are all
# columns of an event: rows that still tie are equal, and any order of them gives the same rows.
FILE_ORDER = ("timestamp", "event_type", "quantity", "metadata")


def unified_feeds(
    clickstream: DataFrame | None = None,
    stock: DataFrame | None = None,
    transactions: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame | None:
    """Unified events of the feeds that are there; None if there is none."""
    keep = list(keep)
    feeds = [
        unify(feed, keep=keep)
        for unify, feed in ((unify_clickstream, clickstream), (unify_stock, stock), (unify_transactions, transactions))
        if feed is not None
    ]
    return union_events(*feeds) if feeds else None


def stock_values(events: DataFrame, order_cols: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Latest ``key, value`` of the on-hand counts, with the order columns they were chosen by."""
    keep = list(order_cols)
    return format_stock_kv(_latest(inventory_batch(events, keep), keep, "on_hand"), keep)


def signal_values(events: DataFrame, threshold: int, order_cols: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Latest ``key, value`` of the velocity signals, with the order columns they were chosen by."""
    keep = list(order_cols)
    return format_signal_kv(_latest(velocity_batch(events, keep, threshold), keep, "type", "window", "count"), keep)


def _latest(rows: DataFrame, order_cols: list[str], *values: str) -> DataFrame:
    # By ids rather than by the written key: the rows are sorted by the ids already.
    return latest_per_key(rows.select(*KEYS, *order_cols, *values), KEYS, order_cols)


def run_inventory(spark: SparkSession, cfg: RetailConfig) -> None:
    """Batch job over the configured files: writes both serving tables, does nothing without files."""
    read = {
        feed: read_json_lines(spark, path)
        for feed, path in (
            ("clickstream", cfg.clickstream_batch_file),
            ("stock", cfg.stock_batch_file),
            ("transactions", cfg.transaction_batch_file),
        )
        if path
    }
    events = unified_feeds(**read)
    if events is None:
        return
    # Both branches pass over the events several times; a table keeps JSON parsing to one pass.
    with computed_once(events, "unified") as parsed:
        most = parsed.count()
        upsert_latest(stock_values(parsed), cfg.table("stock_serving"), ["key"], FILE_ORDER, most=most)
        upsert_latest(signal_values(parsed, cfg.fast_threshold), cfg.table("signal_serving"), ["key"], FILE_ORDER, most=most)


def start_inventory(events: DataFrame, cfg: RetailConfig, checkpoint: str, order_cols: Sequence[str] = ("timestamp",), **trigger):
    """Streaming job over unified events: two queries that keep the serving tables current."""
    order = list(order_cols)

    def writer(fmt, table, *values):
        def write(batch: DataFrame, load: str) -> None:
            # Micro-batches follow one another, so the version leads the order of the values. Keys are written for the latest rows only.
            latest = fmt(_latest(batch, order, *values), order)
            upsert_latest(latest, cfg.table(table), ["key"], ["version", *order], load)

        return write

    on_hand = inventory_stream(events, order)
    signals = velocity_stream(events, order, cfg.fast_threshold, idle_ms=cfg.velocity_idle_ms)
    return (
        start_batches(on_hand, writer(format_stock_kv, "stock_serving", "on_hand"), f"{checkpoint}/stock", **trigger),
        start_batches(signals, writer(format_signal_kv, "signal_serving", "type", "window", "count"), f"{checkpoint}/signal", **trigger),
    )
