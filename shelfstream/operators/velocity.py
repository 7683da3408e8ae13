"""Sales velocity signal per store and product, as a batch computation.

Per key in arrival order: the reference time is the newest event time so far, quantities are kept in
minute buckets, and each sale reports the last hour if that reaches the threshold, else the last day.

A sale is live when it arrives unless it is already outside the window, and stays live until the
reference minute has moved past it. So a window sum is (live quantity added so far) minus (live
quantity that has run out by the reference minute). Both are running sums: no pairs of rows are made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstream.operators import skew
from shelfstream.operators.inventory import KEYS

MINUTE_MS = 60_000
HOUR = 60
DAY = 24 * 60
THRESHOLD = 100


def velocity_batch(
    events: DataFrame,
    order_cols: Sequence[str],
    threshold: int = THRESHOLD,
    keys: Sequence[str] = KEYS,
    event_types: Sequence[str] = ("SALE",),
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> DataFrame:
    """Every event of ``event_types`` with its signal columns ``type, window, count``."""
    return velocity_from(None, events, order_cols, threshold, keys, event_types, splits, min_chunk_rows)


def _sales(events: DataFrame, event_types: Sequence[str]) -> DataFrame:
    sold = events.filter(F.col("event_type").isin(*event_types)).withColumn("sold", F.abs("quantity"))
    return sold.withColumn("minute", F.expr(f"timestamp div {MINUTE_MS}"))


def velocity_from(
    state: DataFrame | None,
    events: DataFrame,
    order_cols: Sequence[str],
    threshold: int = THRESHOLD,
    keys: Sequence[str] = KEYS,
    event_types: Sequence[str] = ("SALE",),
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
    most: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """:func:`velocity_batch` for events that follow earlier ones.

    ``state`` is that of :func:`closing_velocity`, None at the start; ``most`` is a known bound of a key's rows, its buckets included,
    and ``total`` one of all rows.
    """
    keys, order_cols = list(keys), list(order_cols)
    sales = _sales(events, event_types)
    if state is not None:
        # Buckets replay as rows before all others, oldest minute first; null order columns keep them in a hot key's first chunk.
        replayed = _bucket_rows(state, keys).withColumns({"bucket": F.col("minute"), "is_event": F.lit(False)})
        sales = sales.withColumn("is_event", F.lit(True)).unionByName(replayed, allowMissingColumns=True)
    split = skew.split_hot_keys(sales, keys, order_cols[0], splits, min_chunk_rows, most, total)
    rows = split.rows
    if state is None:
        rows = rows.withColumn("is_event", F.lit(True))
    if split.chunks is not None:
        rows = rows if state is not None else rows.withColumn("bucket", F.lit(None).cast("bigint"))
        rows = rows.unionByName(_opening_buckets(split, keys), allowMissingColumns=True)
    if split.chunks is not None or state is not None:
        order_cols = ["is_event", "bucket", *order_cols]

    rows = split.spread(rows)
    so_far = (
        Window.partitionBy(*split.group).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    by_minute = Window.partitionBy(*split.group).orderBy("minute")
    rows = rows.withColumn("ref", F.max("minute").over(so_far))
    widths = {"hour": HOUR, "day": DAY}
    live = {
        f"{name}_live": F.when(F.col("minute") > F.col("ref") - width, F.col("sold")).otherwise(F.lit(0))
        for name, width in widths.items()
    }
    gone = {}
    for name, width in widths.items():
        ran_out = F.sum(f"{name}_live").over(by_minute.rangeBetween(Window.unboundedPreceding, -width))
        # Only on-time rows sit at the reference minute; late rows read the newest of those instead.
        gone[f"{name}_gone"] = F.when(F.col("minute") == F.col("ref"), F.coalesce(ran_out, F.lit(0)))
    sums = {name: F.sum(f"{name}_live").over(so_far) - F.max(f"{name}_gone").over(so_far) for name in widths}
    rows = rows.withColumns(live).withColumns(gone).withColumns(sums)
    fast = F.col("hour") >= threshold
    return rows.filter("is_event").select(
        *events.columns,
        F.when(fast, "FAST").otherwise("SLOW").alias("type"),
        F.when(fast, "1h").otherwise("24h").alias("window"),
        F.when(fast, F.col("hour")).otherwise(F.col("day")).alias("count"),
    )


def _bucket_rows(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.select(*keys, F.explode("buckets").alias("bucket")).select(*keys, "bucket.minute", "bucket.sold")


def closing_velocity(
    state: DataFrame | None, events: DataFrame, keys: Sequence[str] = KEYS, event_types: Sequence[str] = ("SALE",)
) -> DataFrame:
    """Per key of ``events`` the minute ``buckets`` that are still in its day window, and its newest event time ``seen``.

    At most ``DAY`` buckets a key; older ones are evicted here.
    """
    keys = list(keys)
    sold = _sales(events, event_types).select(*keys, "minute", "sold")
    if state is not None:
        sold = sold.unionByName(_bucket_rows(state, keys))
    minutes = sold.groupBy(*keys, "minute").agg(F.sum("sold").alias("sold"))
    live = minutes.withColumn("ref", F.max("minute").over(Window.partitionBy(*keys))).filter(F.col("minute") > F.col("ref") - DAY)
    buckets = F.sort_array(F.collect_list(F.struct("minute", "sold"))).alias("buckets")
    return live.groupBy(*keys).agg(buckets, (F.max("ref") * MINUTE_MS).alias("seen"))


def _opening_buckets(split: skew.Split, keys) -> DataFrame:
    """The minute buckets still in the day window when a later chunk of a hot key starts."""
    by_chunk = [*keys, "chunk"]
    hot_rows = split.rows.filter("is_hot")
    newest = hot_rows.groupBy(*by_chunk).agg(F.max("minute").alias("newest"))
    starts = (
        split.chunks.join(F.broadcast(newest), by_chunk, "left")
        .withColumn("ref", F.max("newest").over(skew.before(keys)))
        .filter("ref is not null")
    )
    # At most DAY rows per chunk ask for a bucket; what was sold before answers through a running sum.
    asked = starts.select(
        *by_chunk,
        F.explode(F.expr(f"sequence(ref - {DAY - 1}, ref)")).alias("minute"),
        "ref",
        F.lit(0).cast("bigint").alias("sold"),
    )
    sold = hot_rows.groupBy(*by_chunk, "minute").agg(F.sum("sold").alias("sold")).withColumn("ref", F.lit(None).cast("bigint"))
    # Within one chunk the question sorts first, so it sees earlier chunks only.
    so_far = (
        Window.partitionBy(*keys, "minute")
        .orderBy("chunk", F.col("ref").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        asked.unionByName(sold)
        .withColumn("sold", F.sum("sold").over(so_far))
        .filter("ref is not null and (sold > 0 or minute = ref)")
        .select(*by_chunk, "minute", "sold", F.col("minute").alias("bucket"), F.lit(False).alias("is_event"))
    )
