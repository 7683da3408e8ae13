"""Late rows of a stream: a gate before windowed counts that turns what they would drop into dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstream.schemas import ERROR_MSG
from shelfstream.sinks.append import append_table
from shelfstream.sinks.dead_letter import dead_letter
from shelfstream.sinks.serving import read_latest, upsert_latest
from shelfstream.streaming.runs import start_batches

LATE = "Event is later than the watermark of its window"


def is_late(watermark_ms: int | None, window_ms: int, time_col: str = "timestamp") -> Column:
    """Whether the fixed window of a row had closed by the watermark; null times are not late."""
    if watermark_ms is None:
        return F.lit(False)
    time = F.col(time_col)
    end = time - F.pmod(time, F.lit(window_ms)) + F.lit(window_ms)
    return F.coalesce(end <= F.lit(watermark_ms), F.lit(False))


def late_letters(late: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Late rows in the dead-letter layout, the row as JSON."""
    return late.select(
        F.lit(None).cast("string").alias("transform"),
        F.lit(LATE).alias("error"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in late.columns])).alias("data"),
        F.timestamp_millis(F.col(time_col)).alias("timestamp"),
    ).select(*ERROR_MSG.names)


def start_gate(
    events: DataFrame,
    on_time_path: str,
    letters_path: str,
    checkpoint: str,
    window_ms: int,
    delay_ms: int,
    time_col: str = "timestamp",
    on_late: Callable[[int], None] | None = None,
    **trigger,
):
    """Split a stream into the table of rows in time and the dead letters of late ones; ``on_late`` gets the number of each batch.

    The watermark of a micro-batch is the newest time of all earlier ones less ``delay_ms``, as Spark's own, and the same again
    when a micro-batch is repeated. Counts that follow the table with that delay drop nothing: their watermark comes from the
    same rows and never is ahead. So rows counted and letters add up to the rows of the stream.
    """
    newest_path = f"{checkpoint}/newest"

    def work(batch: DataFrame, load: str) -> None:
        rows = batch.persist()
        spark = rows.sparkSession
        earlier = read_latest(spark, newest_path, ["clock"], ["version"], load)
        known = earlier.first() if earlier is not None else None
        late = is_late(known.newest - delay_ms if known else None, window_ms, time_col)
        append_table(rows.where(~late), on_time_path, load)
        append_table(dead_letter(late_letters(rows.where(late), time_col)), letters_path, load)
        seen = rows.agg(F.max(time_col).alias("newest"), F.count_if(late).alias("late")).first()
        newest = max((t for t in (seen.newest, known and known.newest) if t is not None), default=None)
        if newest is not None:
            clock = spark.createDataFrame([("newest", newest)], "clock string, newest long")
            upsert_latest(clock, newest_path, ["clock"], ["version"], load, buckets=1, unique=True)
        rows.unpersist()
        if on_late:
            on_late(seen.late)

    return start_batches(events, work, checkpoint, **trigger)
