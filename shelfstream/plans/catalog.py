"""The named queries over the sample tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.config import RetailConfig
from shelfstream.functions.scalars import conform
from shelfstream.operators import counts, enrich, parse, quality, sessions, unify
from shelfstream.operators.inventory import dropped_by_reset, inventory_batch
from shelfstream.operators.velocity import velocity_batch
from shelfstream.plans import clickstream as clickstream_plan
from shelfstream.plans import inventory as inventory_plan
from shelfstream.plans import stock as stock_plan
from shelfstream.plans import transactions as transactions_plan
from shelfstream.schemas import CLICKSTREAM, PAGE_VIEW_AGG, STOCK, STOCK_AGG, TRANSACTION
from shelfstream.session import shared_dir
from shelfstream.sinks import append, dead_letter, serving
from shelfstream.sources import json_lines
from shelfstream.sources import sample_feeds as feeds
from shelfstream.streaming.dimension import RefreshingDimension, VersionedDimension
from shelfstream.streaming.inventory_state import inventory_stream
from shelfstream.streaming.lateness import start_gate
from shelfstream.streaming.runs import put_in_order, replay, replay_to_table, run_to_table, start_batches
from shelfstream.streaming.session_state import append_sessions, closed_session_events
from shelfstream.streaming.velocity_state import velocity_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TWELVE_HOURS = 12 * 3_600_000
HOUR = 3_600_000
EVENT_COLS = ("store_id", "product_id", "event_type", "quantity", "timestamp", "arrival_ms", "l_orderkey", "l_linenumber")
SIGNAL_COLS = ("store_id", "product_id", "quantity", "timestamp", "arrival_ms", "l_orderkey", "l_linenumber", "type", "window", "count")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _warehouse(spark: SparkSession, **settings) -> RetailConfig:
    return RetailConfig(warehouse=shared_dir(spark, "warehouse"), **settings)


# Keyed state ------------------------------------------------------------------------------------


@query
def inventory_on_hand(spark, sf_dir):
    return inventory_batch(feeds.unified(spark, sf_dir), feeds.ARRIVAL).select(*EVENT_COLS, "on_hand")


@query
def inventory_latest_kv(spark, sf_dir):
    return inventory_plan.stock_values(feeds.unified(spark, sf_dir), feeds.ARRIVAL).select("key", "value")


@query
def dropped_by_reset_audit(spark, sf_dir):
    return dropped_by_reset(feeds.unified(spark, sf_dir), feeds.ARRIVAL).select(*EVENT_COLS, "last_reset")


@query
def velocity_signal(spark, sf_dir):
    return velocity_batch(feeds.unified(spark, sf_dir), feeds.ARRIVAL).select(*SIGNAL_COLS)


@query
def velocity_signal_20(spark, sf_dir):
    return velocity_batch(feeds.unified(spark, sf_dir), feeds.ARRIVAL, threshold=20).select(*SIGNAL_COLS)


@query
def velocity_latest_kv(spark, sf_dir):
    return inventory_plan.signal_values(feeds.unified(spark, sf_dir), 100, feeds.ARRIVAL).select("key", "value")


@query
def serving_table_stock(spark, sf_dir):
    """Upsert into a serving table, then read its current version."""
    path = shared_dir(spark, "serving")
    values = inventory_plan.stock_values(feeds.unified(spark, sf_dir), feeds.ARRIVAL)
    serving.upsert_latest(values, path, ["key"], feeds.ARRIVAL)
    return serving.read_latest(spark, path, ["key"], feeds.ARRIVAL).select("key", "value")


# Parse and unify --------------------------------------------------------------------------------


@query
def unify_clickstream(spark, sf_dir):
    return unify.unify_clickstream(feeds.clickstream_json(spark, sf_dir), keep=["event_id"])


@query
def unify_stock(spark, sf_dir):
    return unify.unify_stock(feeds.as_json(feeds.stock(spark, sf_dir)))


@query
def unify_transactions(spark, sf_dir):
    return unify.unify_transactions(feeds.as_json(feeds.transactions(spark, sf_dir)))


def _all_feeds(spark, sf_dir):
    return inventory_plan.unified_feeds(
        feeds.clickstream_json(spark, sf_dir),
        feeds.as_json(feeds.stock(spark, sf_dir)),
        feeds.as_json(feeds.transactions(spark, sf_dir)),
    )


@query
def union_events(spark, sf_dir):
    keyed = unify.with_key(_all_feeds(spark, sf_dir))
    return keyed.groupBy("key", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


def _click_view(df):
    """Clickstream rows with the nested items as plain columns."""
    plain = [c for c in df.columns if c not in ("ecommerce", "errors", "value", "error", "user_id")]
    return df.select(
        *plain,
        F.col("user_id"),
        F.size("ecommerce.items").alias("n_items"),
        F.get("ecommerce.items", F.lit(0))["item_id"].alias("item_id"),
        F.get("ecommerce.items", F.lit(0))["item_name"].alias("item_name"),
        F.get("ecommerce.items", F.lit(0))["item_brand"].alias("item_brand"),
        F.get("ecommerce.items", F.lit(0))["item_category"].alias("item_category"),
        F.get("ecommerce.items", F.lit(0))["price"].cast("double").alias("price"),
        F.get("ecommerce.items", F.lit(0))["quantity"].alias("item_quantity"),
    )


@query
def parse_clickstream_good(spark, sf_dir):
    return _click_view(parse.good_rows(parse.parse_json(feeds.clickstream_json(spark, sf_dir), CLICKSTREAM)))


def _parse_letters(spark, sf_dir):
    parsed = parse.parse_json(feeds.clickstream_json(spark, sf_dir), CLICKSTREAM)
    return parse.parse_errors(parsed, F.timestamp_millis("arrival_ms"))


@query
def parse_clickstream_bad(spark, sf_dir):
    return _parse_letters(spark, sf_dir).select("transform", "error", "data", F.unix_millis("timestamp").alias("at_ms"))


@query
def dead_letter_log_lines(spark, sf_dir):
    return dead_letter.dead_letter_lines(_parse_letters(spark, sf_dir))


@query
def dead_letter_clamped(spark, sf_dir):
    """Letters whose time is missing, or past what a warehouse can store, get the latest storable time."""
    events = feeds.clickstream(spark, sf_dir)
    at = F.when(F.col("event") == "browse", F.col("arrival_ms")).when(
        F.col("event") == "ERROR", F.col("arrival_ms") + F.lit(253_402_300_800_000)
    )
    letters = events.select(F.col("event").alias("data"), F.timestamp_millis(at).alias("timestamp"), "event_id")
    return dead_letter.dead_letter(letters).select("data", "event_id", F.unix_millis("timestamp").alias("at_ms"))


@query
def parse_stock_rows(spark, sf_dir):
    parsed = parse.parse_json(feeds.as_json(feeds.stock(spark, sf_dir)), STOCK)
    return parse.good_rows(parsed).withColumn("price", F.col("price").cast("double"))


@query
def parse_transaction_rows(spark, sf_dir):
    parsed = parse.parse_json(feeds.as_json(feeds.transactions(spark, sf_dir)), TRANSACTION)
    return parse.good_rows(parsed).withColumn("price", F.col("price").cast("double")).drop("storeLocation")


# Counts -----------------------------------------------------------------------------------------


def _clicks(spark, sf_dir):
    return unify.drop_error_events(feeds.clickstream(spark, sf_dir))


@query
def page_views_5s(spark, sf_dir):
    return conform(counts.page_views(counts.with_event_time(_clicks(spark, sf_dir))), PAGE_VIEW_AGG)


@query
def page_views_1h(spark, sf_dir):
    return conform(counts.page_views(counts.with_event_time(_clicks(spark, sf_dir)), HOUR), PAGE_VIEW_AGG)


@query
def page_view_cells(spark, sf_dir):
    cells = serving.page_view_cells(page_views_1h(spark, sf_dir))
    return cells.withColumn("value", F.hex("value"))


@query
def non_error_events(spark, sf_dir):
    return _clicks(spark, sf_dir).groupBy("event").agg(F.count(F.lit(1)).alias("n"))


def _stock_counts(spark, sf_dir):
    return counts.stock_counts(counts.with_event_time(feeds.stock(spark, sf_dir)))


@query
def stock_counts(spark, sf_dir):
    return conform(_stock_counts(spark, sf_dir), STOCK_AGG)


@query
def global_stock_updates(spark, sf_dir):
    return conform(counts.global_stock_updates(_stock_counts(spark, sf_dir)), STOCK_AGG)


def _transaction_counts(spark, sf_dir):
    return counts.transaction_counts(counts.with_event_time(feeds.transactions(spark, sf_dir)))


@query
def transaction_counts(spark, sf_dir):
    return conform(_transaction_counts(spark, sf_dir), STOCK_AGG)


@query
def global_stock_from_transactions(spark, sf_dir):
    return conform(counts.global_stock_from_transactions(_transaction_counts(spark, sf_dir)), STOCK_AGG)


# Sessions ---------------------------------------------------------------------------------------


@query
def sessions_30s(spark, sf_dir):
    return sessions.session_summary(feeds.clickstream(spark, sf_dir))


@query
def sessions_12h(spark, sf_dir):
    return sessions.session_summary(feeds.clickstream(spark, sf_dir), TWELVE_HOURS)


@query
def session_events_12h(spark, sf_dir):
    tagged = sessions.session_events(feeds.clickstream(spark, sf_dir), TWELVE_HOURS)
    return tagged.select("event_id", "client_id", "timestamp", "session_start")


@query
def sessionized_12h(spark, sf_dir):
    """Nested sessions, shown with the number and the names of their events in time order."""
    return _session_view(sessions.sessionize(feeds.clickstream(spark, sf_dir), TWELVE_HOURS))


def _session_view(nested):
    names = F.array_join(F.transform("value", lambda e: e["event"]), ",")
    return nested.select(
        F.col("key.client_id").alias("client_id"), "session_start", "part", F.size("value").alias("n_events"), names.alias("events")
    )


# Data quality -----------------------------------------------------------------------------------


@query
def missing_items_dead_letter(spark, sf_dir):
    letters = quality.missing_item_letters(feeds.clickstream(spark, sf_dir), F.timestamp_millis("arrival_ms"))
    return letters.select(
        F.get_json_object("data", "$.event_id").cast("bigint").alias("event_id"),
        "error",
        F.unix_millis("timestamp").alias("at_ms"),
    )


@query
def invalid_items(spark, sf_dir):
    events = feeds.clickstream(spark, sf_dir)
    flagged = quality.flag_invalid_items(quality.with_errors(events.filter(~quality.items_missing())))
    return flagged.select("event_id", F.array_join("errors", ",").alias("errors"))


@query
def bad_event_time(spark, sf_dir):
    flagged = quality.flag_bad_event_time(quality.with_errors(feeds.clickstream(spark, sf_dir)), "arrival_ms")
    return flagged.select("event_id", F.array_join("errors", ",").alias("errors"), "timestamp")


@query
def validated_clean(spark, sf_dir):
    clean, _ = quality.validate_and_correct(feeds.clickstream(spark, sf_dir), feeds.catalogue(spark, sf_dir), "arrival_ms")
    return _click_view(clean)


# Stores -----------------------------------------------------------------------------------------


def _joined(spark, sf_dir):
    return enrich.enrich_with_store(feeds.transactions(spark, sf_dir), enrich.store_dimension(feeds.stores(spark, sf_dir)))


def _store_view(df):
    return df.select(
        *[c for c in df.columns if c not in ("storeLocation", "price")], F.col("price").cast("double"), "storeLocation.*"
    )


@query
def store_dimension(spark, sf_dir):
    return enrich.store_dimension(feeds.stores(spark, sf_dir))


@query
def store_locations_table(spark, sf_dir):
    path = shared_dir(spark, "stores")
    feeds.stores(spark, sf_dir).write.parquet(path)
    return json_lines.read_store_locations(spark, path)


@query
def enriched_transactions(spark, sf_dir):
    return _store_view(enrich.enriched_rows(_joined(spark, sf_dir)))


@query
def unknown_store_dead_letter(spark, sf_dir):
    return enrich.unknown_store_letters(_joined(spark, sf_dir)).select(
        F.get_json_object("data", "$.order_number").alias("order_number"), "error", F.unix_millis("timestamp").alias("at_ms")
    )


# Tables -----------------------------------------------------------------------------------------


@query
def raw_archive_counts(spark, sf_dir):
    path = shared_dir(spark, "raw")
    append.archive_raw(feeds.clickstream_json(spark, sf_dir), path)
    archived = spark.read.parquet(path).filter("processed_timestamp is not null")
    return archived.groupBy("json").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("messages"))


@query
def raw_archive_content(spark, sf_dir):
    """The archived messages parsed again: nothing of a message is lost or changed."""
    path = shared_dir(spark, "raw")
    append.archive_raw(feeds.clickstream_json(spark, sf_dir), path)
    archived = spark.read.parquet(path).select(F.col("json").alias("value"))
    return _click_view(parse.good_rows(parse.parse_json(archived, CLICKSTREAM)))


@query
def page_view_cells_table(spark, sf_dir):
    """Cells of early counts in a serving table by cell, then those of all events: a later count replaces its cell alone."""
    path, clicks = shared_dir(spark, "cells"), _clicks(spark, sf_dir)
    for part in (clicks.where("event_id % 3 > 0"), clicks):
        cells = serving.page_view_cells(conform(counts.page_views(counts.with_event_time(part), HOUR), PAGE_VIEW_AGG))
        serving.upsert_latest(cells, path, serving.CELL_KEYS, ["version"])
    latest = serving.read_latest(spark, path, serving.CELL_KEYS, ["version"])
    return latest.select(*serving.CELL_KEYS, F.hex("value").alias("value"))


@query
def aggregate_table_roundtrip(spark, sf_dir):
    path = append.append_aggregate(page_views_5s(spark, sf_dir), shared_dir(spark, "aggregates"), "PageView", 5_000)
    return spark.read.parquet(path).drop("load")


@query
def json_lines_roundtrip(spark, sf_dir):
    """The stock feed written as JSON lines and read back as a batch source."""
    path = shared_dir(spark, "lines")
    feeds.as_json(feeds.stock(spark, sf_dir)).write.text(path)
    return unify.unify_stock(json_lines.read_json_lines(spark, path))


# Composite jobs ---------------------------------------------------------------------------------


def _written_lines(df):
    path = shared_dir(df.sparkSession, "lines")
    df.select("value").write.text(path)
    return path


@query
def feeds_to_stock_values(spark, sf_dir):
    """The whole inventory job from three JSON files to the serving table of the counts."""
    cfg = _warehouse(
        spark,
        clickstream_batch_file=_written_lines(feeds.clickstream_json(spark, sf_dir)),
        stock_batch_file=_written_lines(feeds.as_json(feeds.stock(spark, sf_dir))),
        transaction_batch_file=_written_lines(feeds.as_json(feeds.transactions(spark, sf_dir))),
    )
    inventory_plan.run_inventory(spark, cfg)
    return serving.read_latest(spark, cfg.table("stock_serving"), ["key"], inventory_plan.FILE_ORDER).select("key", "value")


@query
def feeds_to_signal_values(spark, sf_dir):
    return inventory_plan.signal_values(_all_feeds(spark, sf_dir), 100).select("key", "value")


@query
def clickstream_job_views(spark, sf_dir):
    """The whole clickstream job, then its page-view table."""
    cfg = _warehouse(spark)
    clickstream_plan.run_clickstream(feeds.clickstream_json(spark, sf_dir), feeds.catalogue(spark, sf_dir), cfg)
    views = spark.read.parquet(append.aggregate_path(cfg.table("aggregates"), "PageView", cfg.window_ms))
    return conform(views, PAGE_VIEW_AGG)


@query
def clickstream_job_letters(spark, sf_dir):
    parsed = parse.parse_json(feeds.clickstream_json(spark, sf_dir), CLICKSTREAM)
    _, dead = clickstream_plan.clean_and_dead(parsed, feeds.catalogue(spark, sf_dir))
    rows = dead_letter.dead_letter(dead)
    return rows.groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_millis("timestamp")).alias("last_ms"))


@query
def transaction_job_rows(spark, sf_dir):
    rows = transactions_plan.run_transactions(
        feeds.as_json(feeds.transactions(spark, sf_dir)), enrich.store_dimension(feeds.stores(spark, sf_dir)), _warehouse(spark)
    )
    return _store_view(rows.withColumn("window_ms", F.unix_millis("window.start")).drop("window", "event_time"))


@query
def stock_job_rows(spark, sf_dir):
    rows = stock_plan.run_stock(feeds.as_json(feeds.stock(spark, sf_dir)), _warehouse(spark))
    return rows.select("product_id", "store_id", "count", "timestamp", F.unix_millis("window.start").alias("window_ms"))


@query
def parse_failure_metrics(spark, sf_dir):
    """Parse failures that the jobs counted on the way, beside the dead letters of parsing."""
    cfg = _warehouse(spark)
    clickstream_plan.run_clickstream(feeds.clickstream_json(spark, sf_dir), feeds.catalogue(spark, sf_dir), cfg)
    stock = feeds.as_json(feeds.stock(spark, sf_dir))
    broken = stock.select(F.concat(F.lit("{"), "value").alias("value")).where(F.crc32("value") % 7 == 0)
    stock_plan.run_stock(stock.unionByName(broken), cfg)
    counted = spark.read.parquet(cfg.table("metrics")).select("feed", "rows", "json_parse_failures")
    letters = spark.read.parquet(cfg.table("dead_letters")).where(F.col("error").isin(parse.BLANK_ERROR, parse.JSON_ERROR))
    letters = letters.groupBy("feed").agg(F.count(F.lit(1)).alias("letters"))
    return counted.join(letters, "feed").select(
        "feed", (F.col("rows") > F.col("json_parse_failures")).alias("has_good"), (F.col("json_parse_failures") == F.col("letters")).alias("same"),
        F.when(F.col("feed") == "clickstream", F.col("json_parse_failures")).alias("failures"),
    )


# Streams: the feed replayed in time order, and the table the stream wrote ----------------------------

# Beyond any window, session and delay after the last event.
_CLOSING_MS = 30 * 86_400_000


def _closing(df, **more):
    last = df.agg(F.max("timestamp")).first()[0]
    return {"timestamp": F.lit(last + _CLOSING_MS), **more}


@query
def inventory_on_hand_stream(spark, sf_dir):
    rows = replay_to_table(feeds.unified(spark, sf_dir), "arrival_ms", lambda events: inventory_stream(events, feeds.ARRIVAL))
    return rows.select(*EVENT_COLS, "on_hand")


@query
def velocity_signal_stream(spark, sf_dir):
    rows = replay_to_table(feeds.unified(spark, sf_dir), "arrival_ms", lambda events: velocity_stream(events, feeds.ARRIVAL))
    return rows.select(*SIGNAL_COLS)


@query
def page_views_1h_stream(spark, sf_dir):
    clicks = feeds.clickstream(spark, sf_dir)

    def views(stream):
        timed = counts.with_event_time(unify.drop_error_events(stream), watermark="10 minutes")
        return conform(counts.page_views(timed, HOUR), PAGE_VIEW_AGG)

    return replay_to_table(clicks, "timestamp", views, closing=_closing(clicks, event=F.lit("heartbeat")))


@query
def global_stock_updates_stream(spark, sf_dir):
    """Two stacked counts in one stream."""
    stock = feeds.stock(spark, sf_dir)

    def updates(stream):
        timed = counts.with_event_time(stream, watermark="10 minutes")
        return conform(counts.global_stock_updates(counts.stock_counts(timed)), STOCK_AGG)

    return replay_to_table(stock, "timestamp", updates, closing=_closing(stock))


@query
def sessions_12h_stream(spark, sf_dir):
    clicks = feeds.clickstream(spark, sf_dir)

    def closed(stream):
        return sessions.session_stream(counts.with_event_time(stream, watermark="10 minutes"), TWELVE_HOURS)

    return replay_to_table(clicks, "timestamp", closed, closing=_closing(clicks))


@query
def sessionized_12h_stream(spark, sf_dir):
    """Nested sessions that the stream builds as it closes them."""
    clicks, table = feeds.clickstream(spark, sf_dir), shared_dir(spark, "sessions")

    def run(stream, checkpoint):
        closed = closed_session_events(counts.with_event_time(stream, watermark="10 minutes"), TWELVE_HOURS)

        def work(batch, load):
            append_sessions(batch, table, TWELVE_HOURS, load)

        start_batches(closed, work, checkpoint).awaitTermination()

    replay(clicks, "timestamp", run, closing=_closing(clicks))
    return _session_view(spark.read.parquet(table))


@query
def late_views_stream(spark, sf_dir):
    """Page views of a stream with planted late events, and the number of letters that those became."""
    clicks = feeds.clickstream(spark, sf_dir)
    span = clicks.agg(F.min("arrival_ms").alias("low"), F.max("arrival_ms").alias("high")).first()
    # Late in every micro-batch but the first, so the last tenth of the arrivals is planted.
    planted = (F.col("event_id") % 50 == 0) & (F.col("arrival_ms") * 10 > span.low + 9 * span.high)
    late = clicks.withColumn("timestamp", F.when(planted, F.col("timestamp") - 400 * 86_400_000).otherwise(F.col("timestamp")))
    table, letters = shared_dir(spark, "on-time"), shared_dir(spark, "letters")
    replay(late, "arrival_ms", lambda stream, checkpoint: start_gate(stream, table, letters, checkpoint, HOUR, 600_000).awaitTermination())
    on_time = spark.read.parquet(table).drop("load")

    def views(stream):
        timed = counts.with_event_time(unify.drop_error_events(stream), watermark="10 minutes")
        return conform(counts.page_views(timed, HOUR), PAGE_VIEW_AGG)

    counted = replay_to_table(on_time, "arrival_ms", views, closing=_closing(on_time, event=F.lit("heartbeat"), arrival_ms=F.lit(1 << 60)))
    lost = spark.read.parquet(letters).agg(F.count(F.lit(1)).alias("count"))
    return counted.select("page", "startTime", "count").unionByName(
        lost.select(F.lit("late").alias("page"), F.lit(None).cast("bigint").alias("startTime"), "count")
    )


def _clickstream_job(spark, sf_dir):
    """Both parts of the streaming job over the messages, with a last message that closes all windows."""
    cfg, messages = _warehouse(spark), feeds.clickstream_json(spark, sf_dir)
    end = messages.agg(F.max("arrival_ms")).first()[0] + _CLOSING_MS
    heartbeat = F.to_json(F.struct(F.lit("heartbeat").alias("event"), F.date_format(F.timestamp_millis(F.lit(end)), "yyyy-MM-dd HH:mm:ss").alias("event_datetime")))
    closing = {"value": heartbeat, "arrival_ms": F.lit(end)}

    def run(stream, checkpoint):
        clickstream_plan.start_clickstream(stream, feeds.catalogue(spark, sf_dir), cfg, checkpoint).awaitTermination()
        for running in clickstream_plan.start_clickstream_counts(spark, cfg, checkpoint):
            running.awaitTermination()

    replay(messages, "arrival_ms", run, closing=closing)
    return cfg


@query
def clickstream_job_stream(spark, sf_dir):
    """The whole clickstream job as streams, then its page-view table."""
    cfg = _clickstream_job(spark, sf_dir)
    views = spark.read.parquet(append.aggregate_path(cfg.table("aggregates"), "PageView", cfg.window_ms))
    return conform(views, PAGE_VIEW_AGG)


@query
def clickstream_job_stream_sessions(spark, sf_dir):
    """The same job's table of nested sessions."""
    cfg = _clickstream_job(spark, sf_dir)
    nested = spark.read.parquet(cfg.table("clickstream_sessions"))
    return nested.select(F.col("key.client_id").alias("client_id"), "session_start", F.size("value").alias("n_events"))


@query
def inventory_job_stream(spark, sf_dir):
    """Both serving tables of the streaming inventory job."""
    cfg = _warehouse(spark)

    def run(stream, checkpoint):
        for running in inventory_plan.start_inventory(stream, cfg, checkpoint, feeds.ARRIVAL):
            running.awaitTermination()

    replay(feeds.unified(spark, sf_dir), "arrival_ms", run)
    tables = [serving.read_latest(spark, cfg.table(t), ["key"], ["version", *feeds.ARRIVAL]) for t in ("stock_serving", "signal_serving")]
    return tables[0].select("key", "value").unionByName(tables[1].select("key", "value"))


@query
def attribute_time_views_stream(spark, sf_dir):
    """Page views by the time in a message attribute, from text files that micro-batches admit by their bytes."""
    folder = shared_dir(spark, "lines")
    lines = feeds.clickstream_json(spark, sf_dir).select("arrival_ms", F.concat_ws("\t", "arrival_ms", "value").alias("value"))
    last = lines.agg(F.max("arrival_ms")).first()[0] + _CLOSING_MS
    lines.repartitionByRange(8, "arrival_ms").select("value").write.text(f"{folder}/0-lines")
    spark.range(1).select(F.lit(f'{last}\t{{"event": "heartbeat"}}').alias("value")).write.text(f"{folder}/1-closing")
    put_in_order(spark, f"{folder}/*/*.txt")
    size = sum(f.getLen() for f in serving.files(spark, f"{folder}/0-lines/*.txt"))
    stream = json_lines.stream_json_lines(spark, f"{folder}/*", max_bytes_per_trigger=str(max(1, size // 3)))
    timed = json_lines.assign_event_time(json_lines.split_attribute(stream), watermark="10 minutes")
    clicks = unify.drop_error_events(parse.good_rows(parse.parse_json(timed, CLICKSTREAM)))
    return run_to_table(conform(counts.page_views(clicks, HOUR), PAGE_VIEW_AGG))


@query
def versioned_stores_stream(spark, sf_dir):
    """Micro-batches joined with the stores as they were at the time of each sale; the last snapshot comes while the stream runs."""
    stores, table = feeds.stores(spark, sf_dir), shared_dir(spark, "enriched")
    dimension = VersionedDimension(spark, shared_dir(spark, "stores"))

    def snapshot(number):
        dimension.add(stores.withColumn("zip", F.col("zip") + 100_000 * number), 1704067200000 + 3 * 86_400_000 * number)

    snapshot(0)
    snapshot(1)

    def run(stream, checkpoint):
        def work(batch, load):
            if 1704067200000 + 6 * 86_400_000 not in dimension.versions():
                snapshot(2)
            append.append_table(enrich.enriched_rows(dimension.enrich(batch)), table, load)

        start_batches(stream, work, checkpoint).awaitTermination()

    replay(feeds.transactions(spark, sf_dir), "timestamp", run)
    return _store_view(spark.read.parquet(table).drop("load"))


@query
def enriched_transactions_stream(spark, sf_dir):
    """Micro-batches joined with a store table that is read again while the stream runs."""
    stores_path, table = shared_dir(spark, "stores"), shared_dir(spark, "enriched")
    feeds.stores(spark, sf_dir).write.parquet(stores_path)
    dimension = RefreshingDimension(spark, stores_path, ttl_seconds=0)

    def run(stream, checkpoint):
        def work(batch, load):
            append.append_table(enrich.enriched_rows(dimension.enrich(batch)), table, load)

        start_batches(stream, work, checkpoint).awaitTermination()

    replay(feeds.transactions(spark, sf_dir), "timestamp", run)
    return _store_view(spark.read.parquet(table).drop("load"))


@query
def two_loads_clean_rows(spark, sf_dir):
    """The stock job run on the two halves of the feed, and all rows its clean table then has."""
    cfg, stock = _warehouse(spark), feeds.stock(spark, sf_dir)
    for half in (0, 1):
        stock_plan.run_stock(feeds.as_json(stock.where(F.col("product_id") % 2 == half)), cfg)
    return spark.read.parquet(cfg.table("stock_clean")).drop("load")


@query
def inventory_on_hand_split(spark, sf_dir):
    """The plan for tables with hot keys, on every key."""
    return inventory_batch(feeds.unified(spark, sf_dir), feeds.ARRIVAL, min_chunk_rows=50).select(*EVENT_COLS, "on_hand")


@query
def velocity_signal_split(spark, sf_dir):
    return velocity_batch(feeds.unified(spark, sf_dir), feeds.ARRIVAL, min_chunk_rows=50).select(*SIGNAL_COLS)


@query
def session_events_split(spark, sf_dir):
    tagged = sessions.session_events(feeds.clickstream(spark, sf_dir), TWELVE_HOURS, min_chunk_rows=5)
    return tagged.select("event_id", "client_id", "timestamp", "session_start")
