"""Splitting of hot keys into consecutive chunks of their arrival order.

An ordered running computation per key puts a whole key into one task. Here a key with more than one
``splits``-th of all rows is cut into chunks of about that size along its leading order column, and a
chunk that turns out crowded (a burst) is cut once more. Fewer than ``splits`` keys can be that large
and fewer than ``splits`` chunks that crowded, so all chunks together number at most ``4 * splits``,
whatever the table size. That bound makes it safe to fetch the list of hot keys when the query is
built and to broadcast the tables per chunk. Without hot keys, as usual, the rows stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPLITS = 16_384
MIN_CHUNK_ROWS = 1_000_000
CROWDED = 4
#: Rows of a task of an ordered computation; a table of more gets more tasks than the session has shuffle partitions.
TASK_ROWS = 500_000
# Chunk numbers are coarse * FINE + fine; a key has far fewer fine chunks than that.
FINE = 1 << 20


@dataclass(frozen=True)
class Split:
    """``group`` are the columns whose rows stay in one task.

    With hot keys, ``rows`` has the columns ``chunk`` and ``is_hot``, and ``chunks`` lists every chunk
    of every hot key; else ``rows`` is the input and ``chunks`` is None. ``total`` is the number of rows, None if it is not known.
    """

    rows: DataFrame
    group: list[str]
    chunks: DataFrame | None = None
    total: int | None = None

    def spread(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt by the group (:func:`spread`)."""
        return spread(rows, self.group, self.total)


def spread(df: DataFrame, group: Sequence[str], total: int | None) -> DataFrame:
    """``df`` of about ``total`` rows dealt by ``group`` into tasks of ``TASK_ROWS``, if the shuffle partitions of the session are too few for that."""
    tasks = -(-(total or 0) // TASK_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *group)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    splits: int = SPLITS,
    min_chunk_rows: int = MIN_CHUNK_ROWS,
    most: int | None = None,
    total: int | None = None,
) -> Split:
    """Split ``df`` by ``keys`` along ``order_col``, a long. Chunk numbers follow the order.

    Counts the rows per key right away (a scan of the key and order columns, combined before the shuffle), unless a known
    bound ``most`` of a key's rows tells that no key is hot; ``total`` is then the number of all rows, if it is known.
    """
    keys = list(keys)
    if most is not None and most <= min_chunk_rows:
        return Split(df, keys, total=total)
    found, total = _hot_keys(df, keys, order_col, splits, min_chunk_rows)
    measured = found.unionByName(total.select(F.coalesce("total", F.lit(0)).alias("total")), allowMissingColumns=True).collect()
    total = next(r.total for r in measured if r.total is not None)
    hot = _local(found, [tuple(r)[:-1] for r in measured if r.total is None])
    if hot is None:
        return Split(df, keys, total=total)
    rows = df.join(F.broadcast(hot), keys, "left").withColumn("coarse", _piece(order_col, "hot"))
    chunks = hot.select(*keys, F.explode(F.expr("sequence(0L, hot_chunks - 1)")).alias("coarse"))
    fine, fine_chunks = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    crowded = _fetch(_crowded_chunks(rows.filter("hot_start is not null"), keys, order_col))
    if crowded is not None:
        rows = rows.join(F.broadcast(crowded), [*keys, "coarse"], "left")
        chunks = chunks.join(F.broadcast(crowded), [*keys, "coarse"], "left")
        fine, fine_chunks = _piece(order_col, "fine"), F.coalesce("fine_chunks", fine_chunks)
    rows = rows.select(
        *df.columns, (F.col("coarse") * FINE + fine).alias("chunk"), F.col("hot_start").isNotNull().alias("is_hot")
    )
    chunks = chunks.select(*keys, "coarse", F.explode(F.sequence(F.lit(0).cast("bigint"), fine_chunks - 1)).alias("fine"))
    return Split(rows, [*keys, "chunk"], chunks.select(*keys, (F.col("coarse") * FINE + F.col("fine")).alias("chunk")), total)


def _fetch(bounded: DataFrame) -> DataFrame | None:
    """The rows of a frame of provably bounded size as a local table; None if there are none."""
    return _local(bounded, bounded.collect())


def _local(bounded: DataFrame, rows: list) -> DataFrame | None:
    return bounded.sparkSession.createDataFrame(rows, bounded.schema) if rows else None


def _piece(order_col: str, name: str):
    return F.coalesce(F.expr(f"(`{order_col}` - {name}_start) div {name}_width"), F.lit(0).cast("bigint"))


def _pieces(name: str) -> list:
    """Columns that cut the range ``lo .. hi`` of ``n`` rows into equal steps of about ``limit`` rows."""
    return [
        F.col("lo").alias(f"{name}_start"),
        F.expr("(hi - lo) div (n div `limit` + 1) + 1").alias(f"{name}_width"),
        F.expr("n div `limit` + 1").alias(f"{name}_chunks"),
    ]


def _sizes(df: DataFrame, keys: list[str], order_col: str, *more) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(order_col).alias("lo"), F.max(order_col).alias("hi"), *more
    )


def _hot_keys(df, keys, order_col, splits, min_chunk_rows) -> tuple[DataFrame, DataFrame]:
    """(the hot keys, the number of all rows)."""
    per_key = _sizes(df, keys, order_col)
    # The total mentions every column of per_key, so both read the same exchange and df is scanned once.
    total = per_key.agg(F.sum(F.expr("if(lo > hi, 0, n)")).alias("total"))
    limit = F.greatest(F.call_function("div", total.scalar(), F.lit(splits)) + 1, F.lit(min_chunk_rows).cast("bigint"))
    sized = per_key.withColumn("limit", limit).filter("n > `limit`")
    return sized.select(*keys, *_pieces("hot"), F.col("limit").alias("hot_limit")), total


def _crowded_chunks(hot_rows: DataFrame, keys, order_col) -> DataFrame:
    cells = [*keys, "coarse"]
    sized = _sizes(hot_rows, cells, order_col, F.max("hot_limit").alias("limit")).filter(f"n > {CROWDED} * `limit`")
    return sized.select(*cells, *_pieces("fine"))


def before(keys: Sequence[str]):
    """Window over the earlier chunks of the same key."""
    return Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
