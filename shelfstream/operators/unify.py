"""The three feeds as one event type: ``product_id, store_id, event_type, quantity, timestamp, metadata``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.functions.scalars import CORRUPT, event_key, opt_int, opt_long, opt_string, with_json_fields
from shelfstream.schemas import UNIFIED

# Event names and the event type each stands for, and the default ids.
CLICKSTREAM_TYPES = {"view_item": "VIEW", "browse": "VIEW", "add-to-cart": "CART_ADD", "purchase": "SALE"}
WEB_STORE = "WEB"
DEFAULT_PAGE = "P1"
UNKNOWN_PRODUCT = "P_Unknown"
PREFIX = "json_"


def _loose_fields(df: DataFrame, names: list[str], value_col: str) -> DataFrame:
    """JSON fields as text, null where absent; lines that are no JSON object are dropped."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    parsed = with_json_fields(df, value_col, schema, PREFIX)
    return parsed.filter((F.trim(value_col) != "") & F.col(PREFIX + CORRUPT).isNull())


def _field(name: str) -> Column:
    return F.col(PREFIX + name)


def _unified(df: DataFrame, keep: list[str], **fields: Column) -> DataFrame:
    typed = [fields[f.name].cast(f.dataType).alias(f.name) for f in UNIFIED.fields]
    return df.select(*typed, *keep)


def unify_clickstream(
    df: DataFrame,
    value_col: str = "value",
    keep: list[str] | None = None,
    types: Mapping[str, str] = CLICKSTREAM_TYPES,
    now_ms: Column | None = None,
) -> DataFrame:
    """Views, cart additions and purchases of the web shop, one unit each; other events are dropped.

    Takes the message's own time, or the processing time where it has none. ``keep`` names extra
    input columns to carry along, such as an arrival order.
    """
    json = _loose_fields(df, ["event", "page", "timestamp"], value_col)
    pairs = [F.lit(x) for pair in types.items() for x in pair]
    own_time = opt_long(_field("timestamp"))
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    events = json.withColumn("_type", F.element_at(F.create_map(*pairs), _field("event")))
    return _unified(
        events.filter("_type is not null"),
        keep or [],
        product_id=opt_string(_field("page"), DEFAULT_PAGE),
        store_id=F.lit(WEB_STORE),
        event_type=F.col("_type"),
        quantity=F.lit(1),
        timestamp=F.when(own_time != 0, own_time).otherwise(now),
        metadata=F.lit(None),
    )


def unify_stock(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Stock messages as receipts; unreadable numbers are 0."""
    json = _loose_fields(df, ["product_id", "store_id", "count", "timestamp"], value_col)
    return _unified(
        json,
        keep or [],
        product_id=opt_int(_field("product_id")),
        store_id=opt_int(_field("store_id")),
        event_type=F.lit("RECEIPT"),
        quantity=opt_long(_field("count")),
        timestamp=opt_long(_field("timestamp")),
        metadata=F.lit(None),
    )


def unify_transactions(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Transaction messages as sales, with the order number as metadata."""
    json = _loose_fields(df, ["product_id", "store_id", "product_count", "time_of_sale", "order_number"], value_col)
    product = F.when(_field("product_id").isNull(), UNKNOWN_PRODUCT).otherwise(
        opt_int(_field("product_id")).cast("string")
    )
    return _unified(
        json,
        keep or [],
        product_id=product,
        store_id=opt_int(_field("store_id")),
        event_type=F.lit("SALE"),
        quantity=opt_long(_field("product_count")),
        timestamp=opt_long(_field("time_of_sale")),
        metadata=opt_string(_field("order_number"), ""),
    )


def union_events(*feeds: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, feeds)


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", event_key(F.col("store_id"), F.col("product_id")))


def drop_error_events(df: DataFrame) -> DataFrame:
    """Drop events named exactly ERROR; a missing name is kept."""
    return df.filter(~F.col("event").eqNullSafe("ERROR"))

