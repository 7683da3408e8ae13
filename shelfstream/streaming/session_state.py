"""Client sessions of a stream: events wait in the state store until the watermark closes their session."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfstream.operators.sessions import DEFAULT_GAP_MS, sessionize
from shelfstream.sinks.append import append_table

#: Events that are read from or handed on by the state at once.
FRAME_ROWS = 10_000
HELD = "timestamp long, payload string"


def merged_spans(starts: np.ndarray, ends: np.ndarray, gap_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where less than the gap lies between them."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.append(True, starts[1:] - ends[:-1] >= gap_ms) if len(starts) else np.zeros(0, bool)
    return starts[first], ends[np.append(first[1:], True)] if len(starts) else ends


class SessionHolder(StatefulProcessor):
    """State per client: the spans of its open sessions, and their events in one of two lists.

    Events are never held in memory together: they are appended frame by frame as they come and read frame by frame when a
    session closes; those of sessions still open then move to the other list. One timer waits for the session that closes
    first; so a client costs a fixed number of state calls per micro-batch, however many sessions it has.
    """

    def __init__(self, gap_ms: int) -> None:
        self._gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "starts array<long>, ends array<long>, side int")
        self._lists = [handle.getListState(f"events_{side}", HELD) for side in (0, 1)]

    def _spans(self) -> tuple[np.ndarray, np.ndarray, int]:
        starts, ends, side = self._open.get() or ([], [], 0)
        return np.array(starts, np.int64), np.array(ends, np.int64), side

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        starts, ends, side = self._spans()
        for frame in rows:
            times = frame["timestamp"].to_numpy(np.int64)
            self._lists[side].appendList(list(zip(times.tolist(), frame["payload"].tolist())))
            starts, ends = merged_spans(np.concatenate([starts, times]), np.concatenate([ends, times]), self._gap)
        self._open.update((starts.tolist(), ends.tolist(), side))
        self._wait(ends)
        return iter(())

    def _wait(self, ends: np.ndarray) -> None:
        # Spans lie apart, so the first one ends first.
        self._handle.registerTimer(int(ends[0]) + self._gap)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        starts, ends, side = self._spans()
        closed = ends + self._gap <= timerValues.getCurrentWatermarkInMs()
        if not closed.any():
            # The session has grown since this timer was set, and has a later one.
            return
        held, kept = self._lists[side], self._lists[1 - side]
        for frame in _frames(held.get()):
            own = np.searchsorted(starts, frame["timestamp"].to_numpy(np.int64), "right") - 1
            done = closed[own]
            stays = frame[~done]
            if len(stays):
                kept.appendList(list(zip(stays["timestamp"].tolist(), stays["payload"].tolist())))
            yield frame[done]
        held.clear()
        if closed.all():
            self._open.clear()
        else:
            self._open.update((starts[~closed].tolist(), ends[~closed].tolist(), 1 - side))
            self._wait(ends[~closed])

    def close(self) -> None:
        pass


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    part = []
    for row in rows:
        part.append(tuple(row))
        if len(part) == FRAME_ROWS:
            yield pd.DataFrame(part, columns=["timestamp", "payload"])
            part = []
    if part:
        yield pd.DataFrame(part, columns=["timestamp", "payload"])


def closed_session_events(df: DataFrame, gap_ms: int = DEFAULT_GAP_MS) -> DataFrame:
    """The events of a stream, each once the watermark on ``event_time`` has closed its session; without ``event_time``.

    All events of a session come out in one micro-batch, on which :func:`shelfstream.operators.sessions.sessionize` builds the
    nested rows. Events at or before the watermark are dropped; those without ``event_time`` never close a session.
    """
    fields = [f for f in df.schema.fields if f.name != "event_time"]
    payload = F.to_json(F.struct(*[f.name for f in fields]))
    # Events without a client are a client of their own; null keys would be lost on the way.
    client = F.coalesce(F.concat(F.lit("client "), "client_id"), F.lit("none")).alias("client")
    waiting = df.where("event_time is not null").select(client, "event_time", "timestamp", payload.alias("payload"))
    closed = waiting.groupBy("client").transformWithStateInPandas(
        statefulProcessor=SessionHolder(gap_ms), outputStructType=HELD, outputMode="Append", timeMode="EventTime"
    )
    return closed.select(F.from_json("payload", T.StructType(fields)).alias("event")).select("event.*")


def append_sessions(closed: DataFrame, path: str, gap_ms: int, load: str) -> None:
    """Append the nested sessions of a micro-batch of :func:`closed_session_events` to the table at ``path``."""
    # Sessions are built in several passes, and each would run the state again.
    events = closed.persist()
    append_table(sessionize(events, gap_ms), path, load)
    events.unpersist()
