"""Validation and correction of clickstream events.

The events carry an ``errors`` array of correction codes between the steps. Events that cannot be
repaired leave as dead letters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstream.functions.scalars import parse_event_datetime
from shelfstream.schemas import ERROR_MSG

# Correction codes, the error text and the events that must name items.
CORR_ITEM = "CORR_ITEM"
CORR_TIME = "CORR_TIME"
MISSING_ITEMS = "Event requires item to be set, but not set"
ITEM_EVENTS = ("add_to_cart", "purchase")
CORRECTED_FIELDS = ("item_name", "item_brand", "item_category")


def with_errors(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", F.array().cast("array<string>"))


def item_required(events: Sequence[str] = ITEM_EVENTS) -> Column:
    return F.coalesce(F.col("event").isin(*events), F.lit(False))


def items_missing(events: Sequence[str] = ITEM_EVENTS) -> Column:
    """True for events that must name items and have none; such events are beyond repair."""
    return item_required(events) & (F.coalesce(F.size("ecommerce.items"), F.lit(0)) <= 0)


def missing_item_letters(df: DataFrame, arrival: Column, events: Sequence[str] = ITEM_EVENTS) -> DataFrame:
    """The events without their items in the dead-letter layout."""
    message = [c for c in df.columns if c != "errors"]
    letters = df.filter(items_missing(events)).select(
        F.lit("missing_items").alias("transform"),
        F.lit(MISSING_ITEMS).alias("error"),
        F.to_json(F.struct(*message)).alias("data"),
        arrival.cast("timestamp").alias("timestamp"),
    )
    return letters.select(*ERROR_MSG.names)


def split_missing_items(
    df: DataFrame, arrival: Column, events: Sequence[str] = ITEM_EVENTS
) -> tuple[DataFrame, DataFrame]:
    """(events that have the items they need, dead letters of the others)."""
    return df.filter(~items_missing(events)), missing_item_letters(df, arrival, events)


def route_by_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events without errors, events to correct)."""
    faulty = F.coalesce(F.size("errors"), F.lit(0)) > 0
    return df.filter(~faulty), df.filter(faulty)


def _flag(df: DataFrame, code: str, condition: Column) -> DataFrame:
    flagged = F.when(condition, F.array_append("errors", F.lit(code))).otherwise(F.col("errors"))
    return df.withColumn("errors", flagged)


def flag_invalid_items(df: DataFrame, events: Sequence[str] = ITEM_EVENTS) -> DataFrame:
    """Append CORR_ITEM where an item of an item event lacks its name, brand or category."""
    incomplete = F.exists(
        "ecommerce.items",
        lambda item: item["item_name"].isNull() | item["item_brand"].isNull() | item["item_category"].isNull(),
    )
    return _flag(df, CORR_ITEM, item_required(events) & F.coalesce(incomplete, F.lit(False)))


def flag_bad_event_time(df: DataFrame, arrival_ms: str) -> DataFrame:
    """Append CORR_TIME where the event time is unreadable or after the arrival, else take it as ``timestamp``."""
    df = df.withColumn("_event_ms", parse_event_datetime(F.col("event_datetime")))
    bad = F.col("_event_ms").isNull() | (F.col("_event_ms") > F.col(arrival_ms))
    df = _flag(df, CORR_TIME, bad)
    return df.withColumn("timestamp", F.when(bad, F.col("timestamp")).otherwise(F.col("_event_ms"))).drop("_event_ms")


def correct_event_time(df: DataFrame, arrival_ms: str) -> DataFrame:
    fixed = F.when(F.array_contains("errors", CORR_TIME), F.col(arrival_ms)).otherwise(F.col("timestamp"))
    return df.withColumn("timestamp", fixed)


def correct_items(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Overwrite name, brand and category of the items of CORR_ITEM events from the catalogue.

    An item whose id the catalogue lacks keeps its fields. The other events take no part in the
    join or the exchange. The optimizer decides by the catalogue's bytes whether to broadcast it.
    """
    flagged = F.array_contains("errors", CORR_ITEM)
    return df.filter(~flagged).unionByName(_corrected(df.filter(flagged), catalogue))


def _corrected(faulty: DataFrame, catalogue: DataFrame) -> DataFrame:
    columns = faulty.columns
    # Grouping needs a name per event. Equal copies within one input partition share theirs and are
    # counted, so it can be derived from the content and survives a rerun of a lost task.
    event = F.struct(*columns)
    named = faulty.select(
        event.alias("event"),
        F.spark_partition_id().alias("part"),
        F.sha2(F.to_json(event, {"ignoreNullFields": "false"}), 256).alias("digest"),
        F.posexplode("ecommerce.items").alias("pos", "item"),
    )
    known = catalogue.groupBy(F.col("item_id").alias("known_id")).agg(
        F.max(F.struct(*CORRECTED_FIELDS)).alias("known")
    )
    looked_up = F.col("item")
    for name in CORRECTED_FIELDS:
        looked_up = looked_up.withField(name, F.col(f"known.{name}"))
    joined = named.join(known, F.col("item.item_id") == F.col("known_id"), "left")
    fixed = joined.withColumn("item", F.when(F.col("known").isNotNull(), looked_up).otherwise(F.col("item")))
    regrouped = fixed.groupBy("part", "digest").agg(
        F.any_value("event").alias("event"),
        F.sort_array(F.collect_set(F.struct("pos", "item"))).alias("placed"),
        F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("copies"),
    )
    items = F.transform("placed", lambda p: p["item"])
    corrected = (
        regrouped.withColumn("event", F.col("event").withField("ecommerce", F.col("event.ecommerce").withField("items", items)))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .select("event.*")
    )
    return corrected.select(*columns)


def validate_and_correct(
    df: DataFrame,
    catalogue: DataFrame,
    arrival_ms: str,
    events: Sequence[str] = ITEM_EVENTS,
) -> tuple[DataFrame, DataFrame]:
    """(clean events in the input's columns, dead letters)."""
    complete, letters = split_missing_items(df, F.timestamp_millis(F.col(arrival_ms)), events)
    # Items are settled before times are looked at, so the routing filter need not parse any time.
    sound, faulty = route_by_errors(flag_invalid_items(with_errors(complete), events))
    items_done = sound.unionByName(_corrected(faulty, catalogue))
    clean = correct_event_time(flag_bad_event_time(items_done, arrival_ms), arrival_ms).drop("errors")
    return clean, letters
