"""The clickstream job: archive, parse, correct, sessionize and count page views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.config import RetailConfig
from shelfstream.functions.scalars import conform
from shelfstream.operators.counts import page_views, with_event_time
from shelfstream.operators.parse import failed_lines_only, good_rows, parse_errors, parse_json, with_failure_count
from shelfstream.operators.quality import validate_and_correct
from shelfstream.operators.sessions import sessionize
from shelfstream.operators.unify import drop_error_events
from shelfstream.schemas import CLICKSTREAM, PAGE_VIEW_AGG
from shelfstream.session import computed_once, configure_streaming
from shelfstream.sinks.append import aggregate_path, append_aggregate, append_failures, append_table, archive_raw, new_load, stream_append, table_exists
from shelfstream.sinks.dead_letter import dead_letter
from shelfstream.streaming.lateness import start_gate
from shelfstream.streaming.runs import start_batches
from shelfstream.streaming.session_state import append_sessions, closed_session_events

ARRIVAL = "arrival_ms"


def with_arrival(messages: DataFrame) -> DataFrame:
    """Messages without an arrival time arrive now."""
    if ARRIVAL in messages.columns:
        return messages
    return messages.withColumn(ARRIVAL, F.unix_millis(F.current_timestamp()))


def clean_and_dead(parsed: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corrected events, dead letters of parsing and validation) of parsed messages."""
    clean, dead = validate_and_correct(good_rows(parsed), catalogue, ARRIVAL)
    return clean, dead.unionByName(parse_errors(parsed, F.timestamp_millis(F.col(ARRIVAL))))


def store_clean(
    messages: DataFrame,
    catalogue: DataFrame,
    cfg: RetailConfig,
    load: str | None = None,
) -> None:
    """Archive the messages, count parse failures and append their clean events and dead letters."""
    archive_raw(messages, cfg.table("clickstream_raw"), load, test_mode=cfg.test_mode)
    counted_rows, counted = with_failure_count(parse_json(with_arrival(messages), CLICKSTREAM))
    with computed_once(failed_lines_only(counted_rows), "parsed") as parsed:
        clean, dead = clean_and_dead(parsed, catalogue)
        append_table(clean, cfg.table("clickstream_clean"), load)
        append_table(dead_letter(dead), cfg.letters("clickstream"), load)
    append_failures(messages.sparkSession, cfg.table("metrics"), "clickstream", counted, load)


def run_clickstream(messages: DataFrame, catalogue: DataFrame, cfg: RetailConfig, load: str | None = None) -> DataFrame:
    """Batch job; returns the clean events that are not errors.

    Every call appends. A ``load`` name makes a repeat of the same load replace its own rows. Later steps
    read the clean table back, so parsing and correction run once.
    """
    load = load or new_load()
    store_clean(messages, catalogue, cfg, load)
    clean = messages.sparkSession.read.parquet(f"{cfg.table('clickstream_clean')}/load={load}")
    append_table(sessionize(conform(clean, CLICKSTREAM), cfg.session_gap_ms), cfg.table("clickstream_sessions"), load)
    without_errors = drop_error_events(clean)
    views = conform(page_views(with_event_time(without_errors), cfg.window_ms), PAGE_VIEW_AGG)
    append_aggregate(views, cfg.table("aggregates"), "PageView", cfg.window_ms, load)
    return without_errors


def start_clickstream(messages: DataFrame, catalogue: DataFrame, cfg: RetailConfig, checkpoint: str, **trigger):
    """Streaming job, first part: keeps the raw, clean and dead-letter tables."""

    def work(batch: DataFrame, load: str) -> None:
        store_clean(batch, catalogue, cfg, load)

    return start_batches(messages, work, f"{checkpoint}/clean", **trigger)


def start_clickstream_counts(spark: SparkSession, cfg: RetailConfig, checkpoint: str, **trigger):
    """Streaming job, second part: follows the clean table with closed sessions, and with page views of the events in time.

    Views follow a table of their own, from which events later than the watermark have been turned into dead letters.
    """
    configure_streaming(spark)

    def follow(path: str) -> DataFrame:
        schema = spark.read.parquet(path).drop("load").schema
        return spark.readStream.schema(schema).parquet(path).select(*schema.names)

    clean, on_time = cfg.table("clickstream_clean"), cfg.table("clickstream_on_time")
    gate = start_gate(
        follow(clean), on_time, cfg.letters("clickstream_late"), f"{checkpoint}/gate", cfg.window_ms, cfg.watermark_ms, **trigger
    )
    if not trigger:
        # Everything there is: the views then have their whole table.
        gate.awaitTermination()
    if not table_exists(spark, on_time):
        spark.createDataFrame([], spark.read.parquet(clean).drop("load").schema).write.parquet(f"{on_time}/load=none")
    timed = with_event_time(conform(follow(clean), CLICKSTREAM), watermark=cfg.watermark)
    sessions = closed_session_events(timed, cfg.session_gap_ms)

    def store_sessions(closed: DataFrame, load: str) -> None:
        append_sessions(closed, cfg.table("clickstream_sessions"), cfg.session_gap_ms, load)

    viewed = with_event_time(follow(on_time), watermark=cfg.watermark)
    views = conform(page_views(drop_error_events(viewed), cfg.window_ms), PAGE_VIEW_AGG)
    return (
        gate,
        start_batches(sessions, store_sessions, f"{checkpoint}/sessions", **trigger),
        stream_append(
            views, aggregate_path(cfg.table("aggregates"), "PageView", cfg.window_ms), f"{checkpoint}/views", **trigger
        ),
    )
