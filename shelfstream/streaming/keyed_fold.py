"""Ordered rules per key over a stream: every micro-batch runs the batch operator from the state that the last one left.

The state is one row per key in a serving table below the query's checkpoint. So a micro-batch has the plan of the batch
operator: hot keys are cut into chunks, rows stay in the JVM, and no worker holds the rows of a key. A repeated micro-batch reads
the state before it and replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.sinks.serving import BUCKETS, read_latest, upsert_latest


@dataclass(frozen=True)
class KeyedFold:
    """A stream under an ordered rule.

    ``run(state, events, most, total)`` gives the rows to hand on (``most`` bounds the rows of a key with those of its state, and
    ``total`` is the number of all these rows), and ``close(state, events, rows)`` the new state of the keys that ``events`` name,
    one row each, with the newest event time ``seen``. ``schema`` is that of the rows. Keys that saw nothing for ``idle_ms``
    before the oldest event of a micro-batch start anew, and their state is removed as its bucket is written whole. ``replayed``
    tells how many rows a key's state replays as. Without ``closes_rows``, ``close`` does not read the rows, and they are not kept
    after the sink has read them.
    """

    events: DataFrame
    keys: Sequence[str]
    run: Callable[[DataFrame | None, DataFrame, int, int], DataFrame]
    close: Callable[[DataFrame | None, DataFrame, DataFrame], DataFrame]
    schema: T.StructType
    replayed: str
    idle_ms: int | None = None
    buckets: int = BUCKETS
    closes_rows: bool = True

    def work(self, sink: Callable[[DataFrame, str], None], state_path: str) -> Callable[[DataFrame, str], None]:
        """``foreachBatch`` work that hands the rows of each micro-batch to ``sink`` and keeps the state."""

        def step(batch: DataFrame, load: str) -> None:
            # These frames are read several times; what a lost executor held is computed again.
            events = batch.persist()
            # One pass tells the keys whose state is needed and whether one of them is hot.
            named = events.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest")).persist()
            size = named.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min("oldest").alias("oldest")).first()
            expired = None
            if self.idle_ms is not None and size.oldest is not None:
                expired = F.col("seen") < F.lit(size.oldest - self.idle_ms)
            most, total, kept = size.most or 0, size.n or 0, [events, named]
            state = self._state(named, state_path, load, expired)
            if state is not None:
                kept.append(state.persist())
                replayed = state.agg(F.max(F.expr(self.replayed)).alias("most"), F.sum(F.expr(self.replayed)).alias("n")).first()
                most, total = most + (replayed.most or 0), total + (replayed.n or 0)
            rows = self.run(state, events, most, total)
            if self.closes_rows:
                kept.append(rows.persist())
            sink(rows.select(*self.schema.names), load)
            closing = self.close(state, events, rows)
            upsert_latest(closing, state_path, self.keys, ["version"], load, self.buckets, expired, unique=True)
            for frame in kept:
                frame.unpersist()

        return step

    def _state(self, named: DataFrame, state_path: str, load: str, expired: Column | None) -> DataFrame | None:
        """State before ``load`` of the keys that ``named`` has one row for."""
        state = read_latest(named.sparkSession, state_path, self.keys, ["version"], load)
        if state is None:
            return None
        state = state.join(named, list(self.keys), "left_semi")
        return state if expired is None else state.filter(~F.coalesce(expired, F.lit(False)))


def state_of(checkpoint: str) -> str:
    """Folder of the state of a fold that runs on ``checkpoint``."""
    return f"{checkpoint}/keyed"
