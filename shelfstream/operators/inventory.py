"""On-hand inventory per store and product with a reset barrier, as a batch computation.

Rules, in arrival order per key: a RESET sets the count and remembers its time; any other event
older than the last RESET is dropped; SALE and SHIPMENT subtract, RECEIPT and RETURN add, and each
of these emits the new count. VIEW and CART_ADD change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstream.operators import skew

KEYS = ("store_id", "product_id")
OUTGOING = ("SALE", "SHIPMENT")
INCOMING = ("RECEIPT", "RETURN")
STOCK_EVENTS = ("RESET", *OUTGOING, *INCOMING)


def signed_quantity() -> Column:
    event = F.col("event_type")
    return F.when(event.isin(*OUTGOING), -F.col("quantity")).when(event.isin(*INCOMING), F.col("quantity")).otherwise(F.lit(0))


def inventory_batch(
    events: DataFrame,
    order_cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> DataFrame:
    """Stock-moving events that pass the barrier, each with ``on_hand`` after it.

    ``order_cols`` is the arrival order within a key; the first must be a long, all together unique.
    """
    moves = events.filter(F.col("event_type").isin(*STOCK_EVENTS))
    rows = _running_state(moves, order_cols, keys, splits, min_chunk_rows)
    return rows.filter("accepted").select(*events.columns, "on_hand")


def dropped_by_reset(
    events: DataFrame,
    order_cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> DataFrame:
    """The events the barrier drops, with the reset time that dropped them as ``last_reset``."""
    rows = _running_state(events, order_cols, keys, splits, min_chunk_rows)
    return rows.filter("not accepted").select(*events.columns, "last_reset")


def inventory_from(
    state: DataFrame | None,
    events: DataFrame,
    order_cols: Sequence[str],
    keys: Sequence[str] = KEYS,
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
    most: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """:func:`inventory_batch` for events that follow earlier ones, with ``last_reset`` beside ``on_hand``.

    ``state`` has ``last_reset`` and ``on_hand`` of each key so far (:func:`closing_inventory`), None at the start; ``most``
    is a known bound of a key's rows, its state included, and ``total`` one of all rows.
    """
    moves = events.filter(F.col("event_type").isin(*STOCK_EVENTS))
    rows = _running_state(moves, order_cols, keys, splits, min_chunk_rows, state, most, total)
    return rows.filter("accepted").select(*events.columns, "last_reset", "on_hand")


def closing_inventory(rows: DataFrame, order_cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``last_reset, on_hand`` and the newest event time ``seen`` of each key after the rows of :func:`inventory_from`."""
    last = F.max_by(F.struct("last_reset", "on_hand"), F.struct(*order_cols))
    return rows.groupBy(*keys).agg(last.alias("last"), F.max("timestamp").alias("seen")).select(*keys, "last.*", "seen")


def _running_state(events, order_cols, keys, splits, min_chunk_rows, state=None, most=None, total=None) -> DataFrame:
    keys, order_cols = list(keys), list(order_cols)
    if state is not None:
        # A key's state replays as one row before all others: null order columns sort first, in the chunks of a hot key as well.
        replayed = state.select(
            *keys,
            F.when(F.col("last_reset").isNotNull(), "RESET").otherwise("RECEIPT").alias("event_type"),
            F.col("on_hand").alias("quantity"),
            F.col("last_reset").alias("timestamp"),
            F.lit(False).alias("is_event"),
        )
        events = events.withColumn("is_event", F.lit(True)).unionByName(replayed, allowMissingColumns=True)
    split = skew.split_hot_keys(events, keys, order_cols[0], splits, min_chunk_rows, most, total)
    rows = split.rows if state is not None else split.rows.withColumn("is_event", F.lit(True))
    if split.chunks is not None:
        rows = rows.unionByName(_opening_rows(split, order_cols, keys), allowMissingColumns=True)
    if split.chunks is not None or state is not None:
        order_cols = ["is_event", *order_cols]

    rows = split.spread(rows)
    # One exchange and one sort serve all three running columns.
    arrival = Window.partitionBy(*split.group).orderBy(*order_cols)
    so_far = arrival.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_reset = F.col("event_type") == "RESET"
    accepted = is_reset | F.col("last_reset").isNull() | (F.col("timestamp") >= F.col("last_reset"))
    moved = F.sum(F.when(accepted, signed_quantity()).otherwise(F.lit(0))).over(so_far)
    # A reset moves the base line such that base + moved equals the counted quantity.
    base = F.last(F.when(is_reset, F.col("quantity") - F.col("moved")), ignorenulls=True).over(so_far)
    return (
        rows.withColumn("last_reset", F.last(F.when(is_reset, F.col("timestamp")), ignorenulls=True).over(so_far))
        .withColumns({"accepted": accepted, "moved": moved})
        .withColumn("on_hand", F.coalesce(base, F.lit(0)) + F.col("moved"))
        .filter("is_event")
    )


def _opening_rows(split: skew.Split, order_cols, keys) -> DataFrame:
    """One row per later chunk of a hot key that replays the state its earlier chunks left behind."""
    by_chunk = [*keys, "chunk"]
    hot_rows = split.rows.filter("is_hot")
    position = F.struct(*order_cols)
    last_resets = (
        hot_rows.filter("event_type = 'RESET'")
        .groupBy(*by_chunk)
        .agg(F.max_by("timestamp", position).alias("reset_time"), F.max(position).alias("reset_position"))
    )
    chunks = (
        split.chunks.join(F.broadcast(last_resets), by_chunk, "left")
        .withColumn("opening_reset", F.last("reset_time", ignorenulls=True).over(skew.before(keys)))
    )
    # Within a chunk only what follows its last reset counts for the closing state.
    barrier = F.coalesce("reset_time", "opening_reset")
    in_tail = F.col("reset_position").isNull() | (position >= F.col("reset_position"))
    passes = (F.col("event_type") == "RESET") | barrier.isNull() | (F.col("timestamp") >= barrier)
    amount = F.when(F.col("event_type") == "RESET", F.col("quantity")).otherwise(signed_quantity())
    tails = (
        hot_rows.join(F.broadcast(chunks), by_chunk).filter(in_tail & passes).groupBy(*by_chunk).agg(F.sum(amount).alias("tail"))
    )
    through = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_segment = Window.partitionBy(*keys, "segment").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        chunks.join(F.broadcast(tails), by_chunk, "left")
        .withColumn("segment", F.count("reset_time").over(through))
        .withColumn("closing", F.coalesce(F.sum("tail").over(in_segment), F.lit(0)))
        .withColumn("opening", F.lag("closing").over(Window.partitionBy(*keys).orderBy("chunk")))
        .filter("chunk > 0")
        .select(
            *by_chunk,
            F.when(F.col("opening_reset").isNotNull(), "RESET").otherwise("RECEIPT").alias("event_type"),
            F.col("opening").alias("quantity"),
            F.col("opening_reset").alias("timestamp"),
            F.lit(False).alias("is_event"),
        )
    )
