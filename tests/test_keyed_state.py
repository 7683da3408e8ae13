import random

import pytest
from pyspark.sql import functions as F

from shelfstream.operators.inventory import dropped_by_reset, inventory_batch
from shelfstream.operators.skew import split_hot_keys
from shelfstream.operators.velocity import velocity_batch
from tests.folds import inventory_fold, velocity_fold

SCHEMA = "seq long, store_id string, product_id string, event_type string, quantity long, timestamp long, metadata string"
T0 = 1672567200000
MIN = 60_000

RESET_SCRIPT = [
    (0, "S1", "P1", "SALE", 10, T0, None),
    (1, "S1", "P1", "RECEIPT", 100, T0 + 5 * MIN, None),
    (2, "S1", "P1", "RESET", 50, T0 + 10 * MIN, None),
    (3, "S1", "P1", "SALE", 5, T0 + 2 * MIN, None),
    (4, "S1", "P1", "SALE", 2, T0 + 15 * MIN, None),
]


def as_dicts(rows):
    return [dict(zip(("seq", "store_id", "product_id", "event_type", "quantity", "timestamp", "metadata"), r)) for r in rows]


def random_rows(n, seed, spread_minutes, reset_share=0.02, hot_share=0.4, burst=False):
    """Out-of-order events over a few keys, one of which holds ``hot_share`` of the rows.

    With ``burst`` most of them arrive within a small part of the time.
    """
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        store, product = ("S0", "P0") if rnd.random() < hot_share else (f"S{rnd.randrange(3)}", f"P{rnd.randrange(4)}")
        kind = "RESET" if rnd.random() < reset_share else rnd.choice(["SALE", "SALE", "RECEIPT", "RETURN", "SHIPMENT", "VIEW", "CART_ADD"])
        late = rnd.choice([0, 0, 0, rnd.randrange(spread_minutes * MIN)])
        place = seq * 7 if not burst or seq < n // 2 else seq * 7 + seq * 5_000
        rows.append((place, store, product, kind, rnd.randrange(0, 30), T0 + seq * 2 * MIN - late, None))
    return rows


def test_reset_script(spark):
    df = spark.createDataFrame(RESET_SCRIPT, SCHEMA)
    got = [r.on_hand for r in inventory_batch(df, ["seq"]).orderBy("seq").collect()]
    assert got == [-10, 90, 50, 48]
    dropped = dropped_by_reset(df, ["seq"]).collect()
    assert [(r.seq, r.last_reset) for r in dropped] == [(3, T0 + 10 * MIN)]


def test_equal_time_passes_and_older_reset_applies(spark):
    rows = [
        (0, "S1", "P1", "RESET", 50, T0 + 10 * MIN, None),
        (1, "S1", "P1", "SALE", 1, T0 + 10 * MIN, None),
        (2, "S1", "P1", "RESET", 7, T0, None),
        (3, "S1", "P1", "RETURN", 2, T0 + 1, None),
        (4, "S1", "P1", "VIEW", 2, T0 + 1, None),
        (5, "S1", "P1", "SHIPMENT", 3, T0 + 2, None),
    ]
    got = [(r.seq, r.on_hand) for r in inventory_batch(spark.createDataFrame(rows, SCHEMA), ["seq"]).orderBy("seq").collect()]
    assert got == [(0, 50), (1, 49), (2, 7), (3, 9), (5, 6)]


@pytest.mark.parametrize("min_chunk_rows, burst", [(1_000_000, False), (200, True), (10, True), (1, False)])
@pytest.mark.parametrize("reset_share", [0.0, 0.01])
def test_inventory_equals_fold(spark, min_chunk_rows, reset_share, burst):
    rows = random_rows(1500, 11, 600, reset_share, burst=burst)
    emitted, dropped = inventory_fold(as_dicts(rows))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = inventory_batch(df, ["seq"], min_chunk_rows=min_chunk_rows).select("seq", "on_hand").collect()
    assert sorted(map(tuple, got)) == sorted((r["seq"], v) for r, v in emitted)
    got = dropped_by_reset(df, ["seq"], min_chunk_rows=min_chunk_rows).select("seq", "last_reset").collect()
    assert sorted(map(tuple, got)) == sorted((r["seq"], v) for r, v in dropped)


@pytest.mark.parametrize("min_chunk_rows, burst", [(1_000_000, False), (200, True), (20, True), (1, False)])
@pytest.mark.parametrize("spread", [90, 4000])
def test_velocity_equals_fold(spark, min_chunk_rows, spread, burst):
    rows = random_rows(1500, 5, spread, burst=burst)
    want = velocity_fold(as_dicts(rows), 100)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = velocity_batch(df, ["seq"], min_chunk_rows=min_chunk_rows).select("seq", "type", "window", "count").collect()
    assert sorted(map(tuple, got)) == sorted((r["seq"], *s) for r, s in want)


def test_velocity_negative_quantity_counts_as_sold(spark):
    rows = [(0, "S", "P", "SALE", -120, T0, None)]
    got = velocity_batch(spark.createDataFrame(rows, SCHEMA), ["seq"]).select("type", "window", "count").collect()
    assert [tuple(r) for r in got] == [("FAST", "1h", 120)]


def test_velocity_per_product_over_all_stores(spark):
    rows = [(i, f"S{i}", "P", kind, 1, T0 + i, None) for i, kind in enumerate(["SALE", "VIEW", "CART_ADD", "SALE"])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = velocity_batch(df, ["seq"], keys=["product_id"], event_types=["VIEW", "CART_ADD"]).agg(F.max("count")).first()[0]
    assert got == 2


def test_hot_key_is_cut_also_where_it_bursts(spark):
    quiet = [(i * 1000, "hot") for i in range(500)] + [(i * 1000, f"k{i % 250}") for i in range(500)]
    burst = [(250_000 + 4 * i, "hot") for i in range(500)]
    df = spark.createDataFrame(quiet + burst, "t long, k string")
    split = split_hot_keys(df, ["k"], "t", splits=1000, min_chunk_rows=5)
    sizes = split.rows.groupBy("k", "is_hot", "chunk").count().collect()
    assert sum(r["count"] for r in sizes) == 1500
    assert {r.k for r in sizes if r.is_hot} == {"hot"}
    assert max(r["count"] for r in sizes if r.is_hot) <= 4 * 5
    assert all(r.chunk == 0 for r in sizes if not r.is_hot)
    listed = {r.chunk for r in split.chunks.collect()}
    assert {r.chunk for r in sizes if r.is_hot} <= listed and len(listed) <= 4 * 1000
    ordered = split.rows.filter("is_hot").orderBy("t").select("chunk").collect()
    assert [r.chunk for r in ordered] == sorted(r.chunk for r in ordered)


def test_tasks_of_an_ordered_computation_follow_its_rows(spark, monkeypatch):
    from shelfstream.operators import skew

    rows = [("S", f"P{i % 40}", "SALE", 1, T0 + i * 60_000, i) for i in range(400)]
    events = spark.createDataFrame(rows, "store_id string, product_id string, event_type string, quantity long, timestamp long, seq long")
    want = {r.seq: r.on_hand for r in inventory_batch(events, ["seq"]).collect()}
    monkeypatch.setattr(skew, "TASK_ROWS", 40, raising=False)
    got = inventory_batch(events, ["seq"])
    assert got.rdd.getNumPartitions() == 10 and {r.seq: r.on_hand for r in got.collect()} == want
    assert velocity_batch(events, ["seq"]).rdd.getNumPartitions() == 10
    assert split_hot_keys(events, ["product_id"], "seq").total == 400
    assert split_hot_keys(events.where("false"), ["product_id"], "seq").total == 0


def test_a_known_bound_of_the_rows_spreads_them_over_tasks(spark, monkeypatch):
    """A micro-batch without a hot key is dealt into tasks of ``TASK_ROWS``, too, and its rows are not counted again."""
    from shelfstream.operators import skew
    from shelfstream.operators.inventory import inventory_from
    from shelfstream.operators.velocity import velocity_from

    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    rows = spark.createDataFrame(random_rows(400, 9, 4000), SCHEMA)
    monkeypatch.setattr(skew, "_hot_keys", None)
    for run in (inventory_from, velocity_from):
        got = run(None, rows.where("event_type != 'VIEW'"), ["seq"], most=400, total=400)
        assert got.select("seq").rdd.getNumPartitions() == 20
