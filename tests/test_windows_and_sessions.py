import random

import pytest
from pyspark.sql import functions as F

from shelfstream.functions.scalars import conform
from shelfstream.operators import counts, sessions
from shelfstream.schemas import PAGE_VIEW_AGG, STOCK_AGG


def test_page_views_count_browse_only(spark):
    rows = [("browse", "P1", 0), ("browse", "P1", 4999), ("browse", "P1", 5000), ("view_item", "P1", 1), (None, "P1", 1), ("browse", "P2", 1)]
    df = counts.with_event_time(spark.createDataFrame(rows, "event string, page string, timestamp long"))
    got = sorted(tuple(r) for r in conform(counts.page_views(df), PAGE_VIEW_AGG).collect())
    assert got == [(5000, 0, "P1", 2), (5000, 0, "P2", 1), (5000, 5000, "P1", 1)]


def test_second_count_counts_rows_not_units(spark):
    rows = [(1, 1, 0), (1, 1, 1), (1, 2, 2), (2, 1, 3), (1, 1, 6000)]
    df = counts.with_event_time(spark.createDataFrame(rows, "product_id int, store_id int, timestamp long"))
    first = counts.stock_counts(df)
    got = sorted(tuple(r) for r in conform(counts.global_stock_updates(first), STOCK_AGG).collect())
    assert got == [(5000, 0, 1, None, 2), (5000, 0, 2, None, 1), (5000, 5000, 1, None, 1)]
    plain = conform(counts.transaction_counts(df), STOCK_AGG).collect()
    assert {(r.durationMS, r.startTime) for r in plain} == {(None, None)} and sum(r["count"] for r in plain) == 5
    again = counts.global_stock_from_transactions(counts.transaction_counts(df))
    assert sorted((r.startTime, r.product_id, r["count"]) for r in again.collect()) == [(0, 1, 2), (0, 2, 1), (5000, 1, 1)]


def test_fixed_window_column(spark):
    df = counts.with_event_time(spark.createDataFrame([(12_345,)], "timestamp long"))
    row = counts.with_fixed_window(df).select(F.unix_millis("window.start"), F.unix_millis("window.end")).first()
    assert tuple(row) == (10_000, 15_000)


def test_distance_equal_to_gap_starts_a_session(spark):
    rows = [("c", t) for t in (0, 30_000, 59_999, 90_000)] + [(None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "client_id string, timestamp long")
    got = sorted(((r.client_id or ""), r.session_start, r.session_end, r.n_events) for r in sessions.session_summary(df).collect())
    assert got == [("", 5, 6, 2), ("c", 0, 0, 1), ("c", 30_000, 59_999, 2), ("c", 90_000, 90_000, 1)]


def brute_sessions(rows, gap):
    by_client, out = {}, {}
    for client, t in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        mine = by_client.setdefault(client, [])
        if mine and t - mine[-1][-1] < gap:
            mine[-1].append(t)
        else:
            mine.append([t])
    for client, groups in by_client.items():
        for g in groups:
            out[(client, g[0])] = g
    return out


@pytest.mark.parametrize("part_rows, min_chunk_rows", [(100_000, 1_000_000), (3, 1_000_000), (100_000, 20), (3, 1)])
@pytest.mark.parametrize("hot", ["hot", None])
def test_sessions_equal_brute_force(spark, part_rows, min_chunk_rows, hot):
    rnd = random.Random(3)
    rows = [(rnd.choice([hot, hot, "a", "b"]), rnd.randrange(-40_000, 400_000)) for _ in range(800)]
    want = brute_sessions(rows, 1_000)
    df = spark.createDataFrame(rows, "client_id string, timestamp long").repartition(4)
    nested = sessions.sessionize(df, 1_000, part_rows, min_chunk_rows=min_chunk_rows).collect()
    got = {}
    for r in sorted(nested, key=lambda r: r.part):
        got.setdefault((r.key.client_id, r.session_start), []).extend(e.timestamp for e in r.value)
    assert got == want
    # Parts follow from the place within the session alone.
    sizes = {(r.key.client_id, r.session_start, r.part): len(r.value) for r in nested}
    assert sizes == {(*k, i // part_rows): min(part_rows, len(v) - i) for k, v in want.items() for i in range(0, len(v), part_rows)}
    summary = {(r.client_id, r.session_start): (r.session_end, r.n_events) for r in sessions.session_summary(df, 1_000).collect()}
    assert summary == {k: (v[-1], len(v)) for k, v in want.items()}


def test_events_of_sessions(spark):
    rows = [("c", t) for t in (0, 10, 5_000, 5_010, 12_000)] + [("d", 5_005)]
    df = spark.createDataFrame(rows, "client_id string, timestamp long")
    chosen = sessions.session_summary(df, 1_000).filter("client_id = 'c' and session_start = 5000")
    assert sorted(map(tuple, sessions.events_of_sessions(df, chosen, 1_000).collect())) == [("c", 5_000), ("c", 5_010)]
