"""The stock job: archive, parse, append, window."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfstream.config import RetailConfig
from shelfstream.operators.counts import with_event_time, with_fixed_window
from shelfstream.operators.parse import failed_lines_only, good_rows, parse_errors, parse_json, with_failure_count
from shelfstream.schemas import STOCK
from shelfstream.session import computed_once
from shelfstream.sinks.append import append_failures, append_table, archive_raw, new_load
from shelfstream.sinks.dead_letter import dead_letter
from shelfstream.streaming.runs import start_batches


def store_stock(messages: DataFrame, cfg: RetailConfig, load: str | None = None) -> None:
    """Archive the messages, count parse failures and append the stock events and the dead letters."""
    archive_raw(messages, cfg.table("stock_raw"), load, test_mode=cfg.test_mode)
    counted_rows, counted = with_failure_count(parse_json(messages.select("value"), STOCK))
    with computed_once(failed_lines_only(counted_rows), "parsed") as parsed:
        append_table(good_rows(parsed).select(*STOCK.names), cfg.table("stock_clean"), load)
        append_table(dead_letter(parse_errors(parsed)), cfg.letters("stock"), load)
    append_failures(messages.sparkSession, cfg.table("metrics"), "stock", counted, load)


def run_stock(messages: DataFrame, cfg: RetailConfig, load: str | None = None) -> DataFrame:
    """Batch job; returns the stock events with event time and fixed window."""
    load = load or new_load()
    store_stock(messages, cfg, load)
    events = messages.sparkSession.read.parquet(f"{cfg.table('stock_clean')}/load={load}")
    return with_fixed_window(with_event_time(events), cfg.window_ms)


def start_stock(messages: DataFrame, cfg: RetailConfig, checkpoint: str, **trigger):
    return start_batches(messages, lambda batch, load: store_stock(batch, cfg, load), f"{checkpoint}/stock", **trigger)
