"""On-hand inventory of a stream: the reset-barrier rules from micro-batch to micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfstream.operators import skew
from shelfstream.operators.inventory import KEYS, STOCK_EVENTS, closing_inventory, inventory_from
from shelfstream.streaming.keyed_fold import KeyedFold


def inventory_stream(
    events: DataFrame,
    order_cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    idle_ms: int | None = None,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> KeyedFold:
    """Every accepted stock event of the stream with ``on_hand`` after it.

    ``order_cols`` give the arrival order of the events of one key within a micro-batch (the first is a long);
    micro-batches follow one another.
    """
    columns = list(dict.fromkeys([*keys, *order_cols, "event_type", "quantity", "timestamp"]))
    moves = events.filter(events["event_type"].isin(*STOCK_EVENTS)).select(*columns)
    return KeyedFold(
        moves,
        list(keys),
        lambda state, batch, most, total: inventory_from(
            state, batch, order_cols, keys, min_chunk_rows=min_chunk_rows, most=most, total=total
        ),
        lambda state, batch, rows: closing_inventory(rows, order_cols, keys),
        T.StructType([*moves.schema.fields, T.StructField("on_hand", T.LongType())]),
        replayed="1",
        idle_ms=idle_ms,
    )
