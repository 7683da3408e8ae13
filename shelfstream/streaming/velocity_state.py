"""Sales velocity of a stream, with the minute buckets of every key kept from micro-batch to micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.operators import skew
from shelfstream.operators.inventory import KEYS
from shelfstream.operators.velocity import THRESHOLD, closing_velocity, velocity_from
from shelfstream.schemas import SIGNAL
from shelfstream.streaming.keyed_fold import KeyedFold


def velocity_stream(
    events: DataFrame,
    order_cols: Sequence[str],
    threshold: int = THRESHOLD,
    keys: Sequence[str] = KEYS,
    event_types: Sequence[str] = ("SALE",),
    idle_ms: int | None = None,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> KeyedFold:
    """Every sale of the stream with its signal columns ``type, window, count``."""
    columns = list(dict.fromkeys([*keys, *order_cols, "event_type", "quantity", "timestamp"]))
    sales = events.filter(F.col("event_type").isin(*event_types)).select(*columns)
    return KeyedFold(
        sales,
        list(keys),
        lambda state, batch, most, total: velocity_from(
            state, batch, order_cols, threshold, keys, event_types, min_chunk_rows=min_chunk_rows, most=most, total=total
        ),
        lambda state, batch, rows: closing_velocity(state, batch, keys, event_types),
        T.StructType([f for f in sales.schema.fields if f.name != "event_type" or "event_type" in order_cols] + SIGNAL.fields),
        replayed="size(buckets)",
        closes_rows=False,
        idle_ms=idle_ms,
    )
