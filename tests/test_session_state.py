from types import SimpleNamespace

import numpy as np
import pandas as pd

from shelfstream.streaming.session_state import SessionHolder, append_sessions


class Held:
    """A state variable of one client in memory."""

    def __init__(self):
        self.value, self.rows = None, []

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value if self.rows is None or not self.rows else iter(self.rows)

    def update(self, value):
        self.value = value

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.value, self.rows = None, []


def test_one_timer_waits_for_all_sessions_of_a_client():
    timers, calls = set(), []
    lists = {}
    handle = SimpleNamespace(
        registerTimer=lambda at: (timers.add(at), calls.append(at)),
        getValueState=lambda *_: Held(),
        getListState=lambda name, _: lists.setdefault(name, Held()),
    )
    holder = SessionHolder(10)
    holder.init(handle)
    rng = np.random.default_rng(4)
    times = np.unique(rng.integers(0, 20_000, 800))
    out, watermark = [], -1
    # A list without rows gives an empty iterator here as in Spark.
    for held in lists.values():
        held.get = lambda held=held: iter(list(held.rows))

    def advance(to):
        for at in sorted(t for t in timers if t <= to):
            timers.discard(at)
            clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: to)
            out.extend(t for frame in holder.handleExpiredTimer(("c",), clock, None) for t in frame["timestamp"])

    for part in np.array_split(times, 8):
        before = len(calls)
        list(holder.handleInputRows(("c",), iter([pd.DataFrame({"timestamp": rng.permutation(part), "payload": "x"})]), None))
        assert len(calls) == before + 1
        watermark = int(part.max()) - 300
        advance(watermark)
        # What is still held belongs to sessions that the watermark has not closed.
        left = sorted(set(times[times <= part.max()].tolist()) - set(out))
        ends = [t for t, after in zip(left, [*left[1:], None]) if after is None or after - t >= 10]
        assert ends[0] + 10 > watermark
    advance(10**9)
    assert sorted(out) == times.tolist()


def test_a_micro_batch_of_closed_sessions_is_computed_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    rows = [(f"c{i % 7}", 1_000 * i, "browse") for i in range(50)]
    closed = spark.createDataFrame(rows, "client_id string, timestamp long, event string").mapInPandas(
        counted, "client_id string, timestamp long, event string"
    )
    append_sessions(closed, str(tmp_path), 30_000, "one")
    assert spark.read.parquet(str(tmp_path)).selectExpr("sum(size(value))").first()[0] == 50
    assert made.value == 50
