"""The transaction job: archive, parse, add the store location, window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shelfstream.config import RetailConfig
from shelfstream.operators.counts import with_event_time, with_fixed_window
from shelfstream.operators.enrich import enriched_rows, unknown_store_letters, enrich_with_store
from shelfstream.operators.parse import failed_lines_only, good_rows, parse_errors, parse_json, with_failure_count
from shelfstream.schemas import TRANSACTION
from shelfstream.session import computed_once
from shelfstream.sinks.append import append_failures, append_table, archive_raw, new_load
from shelfstream.sinks.dead_letter import dead_letter
from shelfstream.streaming.dimension import RefreshingDimension
from shelfstream.streaming.runs import start_batches


Enrich = Callable[[DataFrame], DataFrame]


def parsed(messages: DataFrame) -> DataFrame:
    """Parsed transactions, still with ``value`` and ``error``."""
    return parse_json(messages.select("value"), TRANSACTION)


def enriched_and_dead(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions with their store, dead letters of parsing and of unknown stores)."""
    good = good_rows(joined).select(*TRANSACTION.names)
    return enriched_rows(good), unknown_store_letters(good).unionByName(parse_errors(joined))


def store_transactions(messages: DataFrame, enrich: Enrich, cfg: RetailConfig, load: str | None = None) -> None:
    """Archive the messages, count parse failures and append the enriched transactions and the dead letters."""
    archive_raw(messages, cfg.table("transactions_raw"), load, test_mode=cfg.test_mode)
    counted_rows, counted = with_failure_count(parsed(messages))
    with computed_once(enrich(failed_lines_only(counted_rows)), "parsed") as joined:
        enriched, dead = enriched_and_dead(joined)
        append_table(enriched, cfg.table("transactions_clean"), load)
        append_table(dead_letter(dead), cfg.letters("transactions"), load)
    append_failures(messages.sparkSession, cfg.table("metrics"), "transactions", counted, load)


def run_transactions(messages: DataFrame, stores: DataFrame, cfg: RetailConfig, load: str | None = None) -> DataFrame:
    """Batch job; returns the enriched transactions with event time and fixed window."""
    load = load or new_load()
    store_transactions(messages, lambda tx: enrich_with_store(tx, stores), cfg, load)
    enriched = messages.sparkSession.read.parquet(f"{cfg.table('transactions_clean')}/load={load}")
    return with_fixed_window(with_event_time(enriched), cfg.window_ms)


def start_transactions(messages: DataFrame, cfg: RetailConfig, checkpoint: str, **trigger):
    """Streaming job; the store dimension is read again every ``refresh_seconds``."""
    dimension = RefreshingDimension(messages.sparkSession, cfg.table("store_locations"), cfg.refresh_seconds)

    def work(batch: DataFrame, load: str) -> None:
        store_transactions(batch, dimension.enrich, cfg, load)

    return start_batches(messages, work, f"{checkpoint}/transactions", **trigger)
