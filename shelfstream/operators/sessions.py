"""Client sessions: a client's events belong together until a pause of the gap length or more.

Summaries are found on time bins: events of one client within one gap-wide bin always share a session,
so each bin is reduced to its first and last time and count before anything is shuffled. Event rows
are tagged in one shuffle by client, in which a hot client is spread over chunks of its time line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstream.operators import skew

DEFAULT_GAP_MS = 30_000
PART_ROWS = 100_000


def _bin(gap_ms: int, millis: str = "timestamp"):
    return F.expr(f"({millis} - pmod({millis}, {gap_ms}L)) div {gap_ms}L")


def _bins(df: DataFrame, gap_ms: int, *keys: str) -> DataFrame:
    return df.groupBy(*keys, _bin(gap_ms).alias("bin")).agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("n")
    )


def _with_session_start(bins: DataFrame, gap_ms: int, *clients: str) -> DataFrame:
    by_time = Window.partitionBy(*clients).orderBy("first")
    pause = F.col("first") - F.lag("last").over(by_time)
    starts = F.when(pause.isNull() | (pause >= gap_ms), F.col("first"))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bins.withColumn("session_start", F.last(starts, ignorenulls=True).over(so_far))


def session_summary(df: DataFrame, gap_ms: int = DEFAULT_GAP_MS) -> DataFrame:
    """One row per session: ``client_id, session_start, session_end, n_events`` (epoch ms, ends on the last event)."""
    bins = _with_session_start(_bins(df, gap_ms, "client_id"), gap_ms, "client_id")
    return bins.groupBy("client_id", "session_start").agg(F.max("last").alias("session_end"), F.sum("n").alias("n_events"))


def session_events(
    df: DataFrame,
    gap_ms: int = DEFAULT_GAP_MS,
    part_rows: int = PART_ROWS,
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> DataFrame:
    """Every event with its ``session_start`` and the ``part`` of the session it is in."""
    return _tagged(df, gap_ms, part_rows, splits, min_chunk_rows)[0].select(*df.columns, "session_start", "part")


def _tagged(df, gap_ms, part_rows, splits, min_chunk_rows) -> tuple[DataFrame, list[str]]:
    """(tagged events, columns by which they are spread over tasks)."""
    # Two columns, so that events without a client are a client of their own for equality joins.
    clients = ["known", "client"]
    events = df.withColumns({"known": F.col("client_id").isNotNull(), "client": F.coalesce("client_id", F.lit(""))})
    split = skew.split_hot_keys(events, clients, "timestamp", splits, min_chunk_rows)
    rows = split.rows.withColumns(
        {"is_event": F.lit(True), "opening": F.lit(None).cast("struct<start: bigint, rows: bigint>"), "tie": F.xxhash64(*df.columns)}
    )
    if split.chunks is not None:
        rows = rows.unionByName(_opening_sessions(split, clients, gap_ms), allowMissingColumns=True)
    rows = split.spread(rows)
    # Rows of one time follow a hash of all their columns, so a rerun puts them into the same parts.
    in_order = Window.partitionBy(*split.group).orderBy("is_event", "timestamp", "tie")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.col("timestamp") - F.lag("timestamp").over(in_order)
    rows = rows.withColumns({"pause": pause, "row": F.row_number().over(in_order)})
    # An opening row stands for the last of the session's rows in earlier chunks.
    fresh = F.when(
        F.col("pause").isNull() | (F.col("pause") >= gap_ms), F.struct(F.col("timestamp").alias("start"), F.lit(1).cast("bigint").alias("rows"))
    )
    begun = F.coalesce("opening", fresh)
    session = F.last(F.when(begun.isNotNull(), F.struct(begun.alias("begun"), F.col("row").alias("row"))), ignorenulls=True).over(so_far)
    rows = rows.withColumn("session", session)
    place = F.col("session.begun.rows") - 1 + F.col("row") - F.col("session.row")
    part = F.call_function("div", place, F.lit(part_rows)).cast("bigint")
    tagged = rows.withColumns({"session_start": F.col("session.begun.start"), "part": part})
    return tagged.filter("is_event"), split.group


def _opening_sessions(split: skew.Split, clients: list[str], gap_ms: int) -> DataFrame:
    """One row per later chunk of a hot client: its last event before the chunk, that one's session and its rows so far."""
    by_chunk = [*clients, "chunk"]
    bins = _with_session_start(_bins(split.rows.filter("is_hot"), gap_ms, *by_chunk), gap_ms, *clients)
    pieces = bins.groupBy(*by_chunk, "session_start").agg(F.max("last").alias("closed"), F.sum("n").alias("n"))
    so_far = Window.partitionBy(*clients, "session_start").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("rows", F.sum("n").over(so_far))
    closing = pieces.groupBy(*by_chunk).agg(F.max(F.struct("closed", F.col("session_start").alias("start"), "rows")).alias("closing"))
    earlier = skew.before(clients)
    return (
        split.chunks.join(F.broadcast(closing), by_chunk, "left")
        .withColumn("closing", F.max("closing").over(earlier))
        .select(
            *by_chunk,
            F.col("closing.closed").alias("timestamp"),
            F.struct("closing.start", "closing.rows").alias("opening"),
            F.lit(False).alias("is_event"),
        )
        .filter("timestamp is not null")
    )


def sessionize(
    df: DataFrame,
    gap_ms: int = DEFAULT_GAP_MS,
    part_rows: int = PART_ROWS,
    splits: int = skew.SPLITS,
    min_chunk_rows: int = skew.MIN_CHUNK_ROWS,
) -> DataFrame:
    """Nested sessions ``key{client_id}, session_start, part, value[events]``, events ordered by time.

    Part ``p`` holds the events ``p * part_rows`` and following of the session, whatever the size of the table or of the
    client; so a part is bounded. A part of a hot client that runs through two chunks is gathered from both.
    """
    tagged, group = _tagged(df, gap_ms, part_rows, splits, min_chunk_rows)
    first = ["timestamp"] + [c for c in df.columns if c != "timestamp"]
    keys = [*group[:2], "session_start", "part"]
    if len(group) == 2:
        # The rows lie together by client already, so this grouping shuffles nothing.
        parts = tagged.groupBy(*keys).agg(F.any_value("client_id").alias("client_id"), F.sort_array(F.collect_list(F.struct(*first))).alias("value"))
    else:
        pieces = tagged.groupBy(*keys, *group[2:]).agg(F.any_value("client_id").alias("client_id"), F.collect_list(F.struct(*first)).alias("piece"))
        parts = pieces.groupBy(*keys).agg(
            F.any_value("client_id").alias("client_id"), F.sort_array(F.flatten(F.collect_list("piece"))).alias("value")
        )
    return parts.select(F.struct("client_id").alias("key"), "session_start", "part", "value")


def session_stream(df: DataFrame, gap_ms: int = DEFAULT_GAP_MS) -> DataFrame:
    """Closed sessions of a stream with a watermark on ``event_time``, in the :func:`session_summary` layout."""
    # session_window joins events whose distance equals its gap; a session must not, so the gap is
    # a microsecond short of the whole-millisecond one.
    span = F.session_window("event_time", f"{gap_ms * 1000 - 1} microseconds")
    return (
        df.groupBy(span, "client_id")
        .agg(F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"), F.count(F.lit(1)).alias("n_events"))
        .select("client_id", "session_start", "session_end", "n_events")
    )


def events_of_sessions(events: DataFrame, sessions: DataFrame, gap_ms: int = DEFAULT_GAP_MS) -> DataFrame:
    """The events that belong to the given sessions (:func:`session_summary` layout).

    A bin never holds two sessions of one client, so the sessions' bins select the events by equality.
    """
    bins = sessions.select(
        F.col("client_id").alias("_client"),
        F.explode(F.sequence(_bin(gap_ms, "session_start"), _bin(gap_ms, "session_end"))).alias("_bin"),
    )
    same = F.col("client_id").eqNullSafe(F.col("_client")) & (_bin(gap_ms) == F.col("_bin"))
    return events.join(bins, same, "left_semi")
