import json
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfstream.config import RetailConfig
from shelfstream.operators import counts, enrich, sessions
from shelfstream.operators.inventory import inventory_batch
from shelfstream.operators.velocity import velocity_batch
from shelfstream.plans import clickstream as clickstream_plan
from shelfstream.plans import inventory as inventory_plan
from shelfstream.plans import stock as stock_plan
from shelfstream.plans import transactions as transactions_plan
from shelfstream.schemas import CATALOGUE
from shelfstream.session import shared_dir
from shelfstream.sinks import serving
from shelfstream.sources.json_lines import assign_event_time, read_json_lines, split_attribute, stream_json_lines
from shelfstream.streaming.inventory_state import inventory_stream
from shelfstream.streaming.dimension import VersionedDimension
from shelfstream.streaming.lateness import LATE, start_gate
from shelfstream.streaming.runs import replay_to_table, run_to_table
from shelfstream.streaming.session_state import closed_session_events, merged_spans
from shelfstream.streaming.velocity_state import velocity_stream
from tests.folds import inventory_fold, velocity_fold
from tests.test_keyed_state import RESET_SCRIPT, SCHEMA, T0, as_dicts, random_rows


def as_stream(spark, folder, schema, *batches):
    """One parquet file per batch, read back one file per micro-batch in that order."""
    for i, rows in enumerate(batches):
        path = folder / f"{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
    import os
    import time

    stamp = time.time() - 1000
    for i in range(len(batches)):
        for f in (folder / f"{i}").glob("*.parquet"):
            os.utime(f, (stamp + i, stamp + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*"))


def test_reset_script_across_batches(spark, tmp_path):
    events = as_stream(spark, tmp_path, SCHEMA, RESET_SCRIPT[:1], RESET_SCRIPT[1:4], RESET_SCRIPT[4:])
    got = run_to_table(inventory_stream(events, ["seq"]))
    assert [r.on_hand for r in got.orderBy("seq").collect()] == [-10, 90, 50, 48]


@pytest.mark.parametrize("spread", [90, 4000])
def test_streams_equal_folds_and_batch(spark, tmp_path, spread):
    rows = random_rows(600, 21, spread, reset_share=0.03)
    parts = [rows[:250], rows[250:260], rows[260:]]
    for p in parts:
        random.Random(1).shuffle(p)
    events = as_stream(spark, tmp_path, SCHEMA, *parts)
    table = spark.createDataFrame(rows, SCHEMA)

    got = sorted(map(tuple, run_to_table(inventory_stream(events, ["seq"])).select("seq", "on_hand").collect()))
    assert got == sorted((r["seq"], v) for r, v in inventory_fold(as_dicts(rows))[0])
    assert got == sorted(map(tuple, inventory_batch(table, ["seq"]).select("seq", "on_hand").collect()))

    columns = ("seq", "type", "window", "count")
    got = sorted(map(tuple, run_to_table(velocity_stream(events, ["seq"], 60)).select(*columns).collect()))
    assert got == sorted((r["seq"], *s) for r, s in velocity_fold(as_dicts(rows), 60))
    assert got == sorted(map(tuple, velocity_batch(table, ["seq"], 60).select(*columns).collect()))


def test_closed_sessions_and_windows_of_a_stream(spark, tmp_path):
    schema = "client_id string, event string, page string, timestamp long"
    first = [("c", "browse", "P1", t) for t in (0, 30_000, 59_999)]
    last = [("c", "browse", "P1", 90_000), ("d", "browse", "P1", 10_000_000)]
    events = counts.with_event_time(as_stream(spark, tmp_path, schema, first, last), watermark="1 second")
    got = run_to_table(sessions.session_stream(events)).collect()
    assert sorted(tuple(r) for r in got) == [("c", 0, 0, 1), ("c", 30_000, 59_999, 2), ("c", 90_000, 90_000, 1)]
    views = run_to_table(counts.page_views(events).select("startTime", "count")).collect()
    assert sorted(tuple(r) for r in views) == [(0, 1), (30_000, 1), (55_000, 1), (90_000, 1)]


def test_json_line_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"TIMESTAMP": 5}\n\n{"b": 1}\n')
    assert read_json_lines(spark, str(tmp_path)).count() == 3
    assert run_to_table(stream_json_lines(spark, str(tmp_path), 1)).count() == 3
    timed = assign_event_time(spark.createDataFrame([("1000",), ("x",)], "TIMESTAMP string"))
    assert [r.ms for r in timed.select(F.unix_millis("event_time").alias("ms")).collect()] == [1000, None]


def test_shared_dir_lies_below_the_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(root) and a != b


CLICKS = [
    {"event": "browse", "client_id": "c", "page": "P1", "timestamp": T0, "event_datetime": "2023-01-01 10:00:00"},
    {"event": "browse", "client_id": "c", "page": "P1", "timestamp": T0, "event_datetime": "2023-01-01 10:00:01"},
    {"event": "ERROR 7", "client_id": "c", "page": "P1", "event_datetime": "2023-01-01 10:00:02"},
    {"event": "ERROR", "client_id": "c", "page": "P1", "event_datetime": "2023-01-01 10:00:03"},
    {"event": "purchase", "client_id": "c", "page": "P1", "event_datetime": "BROKEN DATE FORMAT!!!", "ecommerce": {"items": [{"item_id": "1"}]}},
    {"event": "purchase", "client_id": "d", "page": "P1", "event_datetime": "2023-01-01 10:00:03", "ecommerce": {"items": []}},
]
SALE = {"store_id": 1, "product_id": 4, "product_count": 3, "time_of_sale": T0, "timestamp": T0, "order_number": "o", "price": 1.0}
ARRIVED = {"store_id": 1, "product_id": 4, "count": 10, "timestamp": T0 - 1}


def messages(spark, rows, *raw):
    arrival = T0 + 60_000
    return spark.createDataFrame([(json.dumps(r), arrival) for r in rows] + [(r, arrival) for r in raw], "value string, arrival_ms long")


def test_inventory_job_on_files(spark, tmp_path):
    files = {}
    for feed, rows in (("clickstream", CLICKS), ("stock", [ARRIVED]), ("transaction", [SALE])):
        path = tmp_path / f"{feed}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
        files[f"{feed}_batch_file"] = str(path)
    cfg = RetailConfig(str(tmp_path / "w"), fast_threshold=3, **files)
    inventory_plan.run_inventory(spark, cfg)
    order = inventory_plan.FILE_ORDER
    stock = serving.read_latest(spark, cfg.table("stock_serving"), ["key"], order).collect()
    assert sorted((r.key, r.value) for r in stock) == [("stock:1:4", "7"), ("stock:WEB:P1", "-2")]
    signal = serving.read_latest(spark, cfg.table("signal_serving"), ["key"], order).collect()
    assert ("signal:1:4", "Signal{type='FAST', window='1h', count=3}") in {(r.key, r.value) for r in signal}
    nothing = RetailConfig(str(tmp_path / "none"))
    inventory_plan.run_inventory(spark, nothing)
    assert not (tmp_path / "none").exists()


def test_inventory_job_on_a_stream(spark, tmp_path):
    events = as_stream(spark, tmp_path / "in", SCHEMA, RESET_SCRIPT[:3], RESET_SCRIPT[3:])
    cfg = RetailConfig(str(tmp_path / "w"))
    for q in inventory_plan.start_inventory(events, cfg, str(tmp_path / "progress"), ["seq"]):
        q.awaitTermination()
    latest = serving.read_latest(spark, cfg.table("stock_serving"), ["key"], ["version", "seq"]).collect()
    assert [(r.key, r.value) for r in latest] == [("stock:S1:P1", "48")]
    latest = serving.read_latest(spark, cfg.table("signal_serving"), ["key"], ["version", "seq"]).collect()
    assert [(r.key, r.value) for r in latest] == [("signal:S1:P1", "Signal{type='SLOW', window='24h', count=17}")]


def check_clickstream_tables(spark, cfg):
    clean = spark.read.parquet(cfg.table("clickstream_clean"))
    assert clean.count() == 5
    bought = clean.filter("event = 'purchase'").first()
    assert bought.timestamp == T0 + 60_000 and bought.ecommerce["items"][0].item_name == "one"
    assert spark.read.parquet(cfg.table("clickstream_raw")).count() == 7
    errors = sorted(r.error for r in spark.read.parquet(cfg.table("dead_letters")).collect())
    assert errors == ["Event requires item to be set, but not set", "Message does not match the schema"]


def test_clickstream_job(spark, tmp_path):
    catalogue = spark.createDataFrame([("1", "one", "b", "c")], CATALOGUE)
    cfg = RetailConfig(str(tmp_path / "w"))
    rows = clickstream_plan.run_clickstream(messages(spark, CLICKS, "{broken"), catalogue, cfg)
    assert rows.count() == 4
    check_clickstream_tables(spark, cfg)
    nested = spark.read.parquet(cfg.table("clickstream_sessions")).collect()
    assert sorted((r.key.client_id, len(r.value)) for r in nested) == [("c", 1), ("c", 4)]
    views = spark.read.parquet(cfg.table("aggregates") + "/PageView_5S").collect()
    assert [(r.page, r["count"], r.startTime) for r in views] == [("P1", 2, T0)]


def test_clickstream_job_on_a_stream(spark, tmp_path):
    catalogue = spark.createDataFrame([("1", "one", "b", "c")], CATALOGUE)
    cfg = RetailConfig(str(tmp_path / "w"), watermark_ms=1000)
    rows = messages(spark, CLICKS, "{broken").collect()
    stream = as_stream(spark, tmp_path / "in", "value string, arrival_ms long", rows[:3], rows[3:])
    clickstream_plan.start_clickstream(stream, catalogue, cfg, str(tmp_path / "p1")).awaitTermination()
    check_clickstream_tables(spark, cfg)
    for q in clickstream_plan.start_clickstream_counts(spark, cfg, str(tmp_path / "p2")):
        q.awaitTermination()
    nested = spark.read.parquet(cfg.table("clickstream_sessions")).collect()
    assert [(r.key.client_id, [e.event for e in r.value]) for r in nested] == [("c", ["browse", "browse", "ERROR 7", "ERROR"])]
    views = spark.read.parquet(cfg.table("aggregates") + "/PageView_5S").collect()
    assert [(r.page, r["count"], r.startTime) for r in views] == [("P1", 2, T0)]


def test_transaction_job(spark, tmp_path):
    cfg = RetailConfig(str(tmp_path / "w"))
    raw_stores = spark.createDataFrame([(1, "Irving", "TX", 72712)], "id long, city string, state string, zip long")
    lost = {**SALE, "store_id": 9}
    df = messages(spark, [SALE, lost], "{broken").select("value")
    rows = transactions_plan.run_transactions(df, enrich.store_dimension(raw_stores), cfg).collect()
    assert [(r.storeLocation.city, r.product_count) for r in rows] == [("Irving", 3)]
    raw_stores.write.parquet(cfg.table("store_locations"))
    other = RetailConfig(str(tmp_path / "w"), transactions_clean="streamed", transactions_raw="raw2", dead_letters="dead2")
    stream = as_stream(spark, tmp_path / "in", "value string", df.collect()[:1], df.collect()[1:])
    transactions_plan.start_transactions(stream, other, str(tmp_path / "p")).awaitTermination()
    assert spark.read.parquet(other.table("transactions_clean")).count() == 1
    assert spark.read.parquet(other.letters("transactions")).count() == 2


def test_stock_job(spark, tmp_path):
    cfg = RetailConfig(str(tmp_path / "w"))
    rows = stock_plan.run_stock(messages(spark, [ARRIVED], "").select("value"), cfg).collect()
    assert [(r.product_id, r["count"]) for r in rows] == [(4, 10)]
    assert spark.read.parquet(cfg.letters("stock")).count() == 1


@pytest.mark.parametrize("slices", [1, 9])
def test_replayed_streams_equal_batch_for_any_number_of_micro_batches(spark, slices):
    rows = random_rows(400, 5, 4000, reset_share=0.03)
    table = spark.createDataFrame(rows, SCHEMA)
    got = replay_to_table(table, "seq", lambda events: inventory_stream(events, ["seq"]), slices)
    assert sorted(map(tuple, got.select("seq", "on_hand").collect())) == sorted(map(tuple, inventory_batch(table, ["seq"]).select("seq", "on_hand").collect()))
    columns = ("seq", "type", "window", "count")
    got = replay_to_table(table, "seq", lambda events: velocity_stream(events, ["seq"], 60), slices)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, velocity_batch(table, ["seq"], 60).select(*columns).collect()))


def test_loads_append_in_batch_then_stream_then_new_checkpoint(spark, tmp_path):
    cfg = RetailConfig(str(tmp_path / "w"))
    load = lambda n: messages(spark, [{**ARRIVED, "count": n}]).select("value")
    for n in (1, 2):
        assert [r["count"] for r in stock_plan.run_stock(load(n), cfg).collect()] == [n]
    for n, checkpoint in ((3, "p1"), (4, "p2")):
        stream = as_stream(spark, tmp_path / checkpoint / "in", "value string", load(n).collect())
        stock_plan.start_stock(stream, cfg, str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(r["count"] for r in spark.read.parquet(cfg.table("stock_clean")).collect()) == [1, 2, 3, 4]
    stock_plan.run_stock(load(5), cfg, "named")
    stock_plan.run_stock(load(6), cfg, "named")
    assert sorted(r["count"] for r in spark.read.parquet(cfg.table("stock_clean")).collect()) == [1, 2, 3, 4, 6]


def test_serving_table_takes_a_stream_on_a_new_checkpoint(spark, tmp_path):
    cfg = RetailConfig(str(tmp_path / "w"))
    for i, rows in enumerate((RESET_SCRIPT, RESET_SCRIPT[:1])):
        events = as_stream(spark, tmp_path / f"in{i}", SCHEMA, rows)
        for q in inventory_plan.start_inventory(events, cfg, str(tmp_path / f"progress{i}"), ["seq"]):
            q.awaitTermination()
    latest = serving.read_latest(spark, cfg.table("stock_serving"), ["key"], ["version", "seq"]).collect()
    assert [(r.key, r.value) for r in latest] == [("stock:S1:P1", "-10")]


def test_slices_of_a_replay_follow_its_rows(spark, monkeypatch):
    from shelfstream.streaming import runs

    monkeypatch.setattr(runs, "SLICE_ROWS", 20)
    table = spark.range(200).select(F.col("id").alias("seq"), F.lit("hot").alias("key"))
    sizes, work = [], lambda batch, load: sizes.append(batch.count())
    runs.replay(table, "seq", lambda stream, checkpoint: runs.start_batches(stream, work, checkpoint).awaitTermination())
    assert sum(sizes) == 200 and max(sizes) <= 40


@pytest.mark.parametrize("min_chunk_rows", [1_000_000, 40])
def test_hot_key_of_a_stream_is_cut_into_chunks(spark, min_chunk_rows):
    """State opens the first chunk of a hot key, whose rows lie in several micro-batches and, in each, in several chunks."""
    rows = random_rows(1200, 17, 600, reset_share=0.01, hot_share=0.7, burst=True)
    table = spark.createDataFrame(rows, SCHEMA)
    got = replay_to_table(table, "seq", lambda events: inventory_stream(events, ["seq"], min_chunk_rows=min_chunk_rows), 3)
    assert sorted(map(tuple, got.select("seq", "on_hand").collect())) == sorted((r["seq"], v) for r, v in inventory_fold(as_dicts(rows))[0])
    got = replay_to_table(table, "seq", lambda events: velocity_stream(events, ["seq"], 60, min_chunk_rows=min_chunk_rows), 3)
    assert sorted(map(tuple, got.select("seq", "type", "window", "count").collect())) == sorted((r["seq"], *s) for r, s in velocity_fold(as_dicts(rows), 60))


def test_repeated_micro_batch_starts_from_the_state_before_it(spark, tmp_path):
    table = spark.createDataFrame(RESET_SCRIPT, SCHEMA)
    got = []
    step = inventory_stream(table, ["seq"]).work(lambda rows, load: got.append([r.on_hand for r in rows.orderBy("seq").collect()]), str(tmp_path / "state"))
    for low, high, load in ((0, 2, "a"), (2, 5, "b"), (2, 5, "b"), (0, 2, "a")):
        step(table.where(F.col("seq").between(low, high - 1)), load)
    assert got == [[-10, 90], [50, 48], [50, 48], [-10, 90]]


def test_micro_batch_without_a_hot_key_is_counted_once(spark, tmp_path, monkeypatch):
    from shelfstream.operators import skew

    rows = [(i, "S1", f"P{i % 20}", "SALE", 1, T0 + i * 1000, None) for i in range(400)]
    table, got = spark.createDataFrame(rows, SCHEMA), []
    monkeypatch.setattr(skew, "_hot_keys", None)
    step = inventory_stream(table, ["seq"], min_chunk_rows=40).work(lambda out, load: got.extend(out.collect()), str(tmp_path / "state"))
    for i in (0, 200):
        step(table.where(F.col("seq").between(i, i + 199)), str(i))
    assert sorted((r.seq, r.on_hand) for r in got) == [(i, -(i // 20) - 1) for i in range(400)]
    # A key that fills more than a chunk is found still.
    with pytest.raises(TypeError):
        step(table.withColumn("product_id", F.lit("hot")), "hot")


def test_streaming_inventory_job_serves_only_the_latest_rows_of_a_micro_batch(spark, tmp_path, monkeypatch):
    sizes, upsert = [], inventory_plan.upsert_latest
    monkeypatch.setattr(inventory_plan, "upsert_latest", lambda df, *more: (sizes.append(df.count()), upsert(df, *more))[1])
    rows = [(i, "S1", f"P{i % 3}", "SALE", 1, T0 + i * 1000, None) for i in range(60)]
    events, cfg = as_stream(spark, tmp_path / "in", SCHEMA, rows[:30], rows[30:]), RetailConfig(str(tmp_path / "w"))
    for q in inventory_plan.start_inventory(events, cfg, str(tmp_path / "progress"), ["seq"]):
        q.awaitTermination()
    assert sizes == [3] * 4
    latest = serving.read_latest(spark, cfg.table("stock_serving"), ["key"], ["version", "seq"]).collect()
    assert sorted((r.key, r.value) for r in latest) == [(f"stock:S1:P{i}", "-20") for i in range(3)]


def test_idle_keys_leave_the_state(spark, tmp_path):
    day = 86_400_000
    rows = [(i, "S1", f"P{i % 50 if i < 50 else 50}", "SALE", 60, T0 + i * day // 20, None) for i in range(120)]
    table, state = spark.createDataFrame(rows, SCHEMA), str(tmp_path / "state")
    kept, sizes = [], []
    fold = velocity_stream(table, ["seq"], 100, idle_ms=day)
    step = replace(fold, buckets=3).work(lambda out, load: kept.extend(out.collect()), state)
    for i in range(0, 120, 10):
        step(table.where(F.col("seq").between(i, i + 9)), str(i))
        sizes.append(serving.read_latest(spark, state, ["store_id", "product_id"], ["version"]).count())
    assert max(sizes) >= 30 and sizes[-1] < 10 and len(kept) == len(rows)
    want = velocity_batch(table, ["seq"], 100)
    columns = ("seq", "type", "window", "count")
    assert sorted(tuple(r[c] for c in columns) for r in kept) == sorted(map(tuple, want.select(*columns).collect()))


def test_spans_merge_where_less_than_the_gap_lies_between():
    rng = random.Random(12)
    for _ in range(200):
        times = [rng.randrange(400) for _ in range(rng.randint(1, 30))]
        gap, starts, ends = rng.choice([1, 10, 40]), np.array([], np.int64), np.array([], np.int64)
        for i in range(0, len(times), 4):
            part = np.array(times[i : i + 4], np.int64)
            starts, ends = merged_spans(np.concatenate([starts, part]), np.concatenate([ends, part]), gap)
        want = []
        for t in sorted(times):
            if want and t - want[-1][1] < gap:
                want[-1][1] = t
            else:
                want.append([t, t])
        assert list(zip(starts.tolist(), ends.tolist())) == [tuple(w) for w in want]


def test_stream_emits_whole_sessions_as_they_close(spark, tmp_path, monkeypatch):
    from shelfstream.streaming import session_state

    monkeypatch.setattr(session_state, "FRAME_ROWS", 3)
    schema = "client_id string, event string, timestamp long, items array<struct<id: string, price: float>>"
    # Spark takes rows at its first watermark, the epoch, for late.
    row = lambda c, t: (c, f"e{t}", T0 + t, [(None, 0.1)] if t % 2 else None)
    # Out of order within the delay; client c goes on while an earlier session of it closes.
    batches = [
        [row("c", t) for t in (0, 40_000, 25_000, 35_000, 29_000)] + [row(None, 5)],
        [row("c", t) for t in (69_999, 100_000, 99_999)] + [row("d", 90_000)],
        [row("d", 130_000), row("c", 131_000)],
        [row("end", 1_000_000)],
    ]
    events = counts.with_event_time(as_stream(spark, tmp_path, schema, *batches), watermark="20 seconds")
    got = run_to_table(closed_session_events(events, 30_000))
    assert got.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    rows = [r for batch in batches[:-1] for r in batch]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, spark.createDataFrame(rows, schema).collect()))


def test_gate_splits_late_rows_and_repeats_itself(spark, tmp_path):
    batches = [[(1, 0), (2, 100_000)], [(3, 39_000), (4, 20_000), (5, 200_000), (6, None)], [(7, 129_000), (8, 135_000), (9, 99_000)]]
    stream = as_stream(spark, tmp_path / "in", "id long, timestamp long", *batches)
    late = []
    table, letters = str(tmp_path / "on-time"), str(tmp_path / "letters")
    start_gate(stream, table, letters, str(tmp_path / "p"), 10_000, 60_000, on_late=late.append).awaitTermination()
    # Windows of 10 s: watermarks 40 s, then 140 s.
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2, 5, 6]
    found = spark.read.parquet(letters).collect()
    assert sorted(json.loads(r.data)["id"] for r in found) == [3, 4, 7, 8, 9] and {r.error for r in found} == {LATE} and late == [0, 2, 3]


def test_stores_as_they_were_at_the_time_of_a_sale(spark, tmp_path):
    dimension = VersionedDimension(spark, str(tmp_path / "stores"))
    sales = spark.createDataFrame([(1, t) for t in (5, 10, 25, 30, None)] + [(2, 25)], "store_id int, timestamp long")
    assert dimension.enrich(sales).where("storeLocation is not null").count() == 0
    for start, zips in ((10, [(1, 100)]), (20, [(1, 200), (2, 201)]), (30, [(1, 300)])):
        stores = [(i, "Irving", "TX", z) for i, z in zips]
        dimension.add(spark.createDataFrame(stores, "id long, city string, state string, zip long"), start)
    got = {(r.store_id, r.timestamp): r.storeLocation and r.storeLocation.zip for r in dimension.enrich(sales).collect()}
    assert got == {(1, 5): None, (1, 10): 100, (1, 25): 200, (1, 30): 300, (1, None): None, (2, 25): 201}
    assert dimension.enrich(sales.where("timestamp = 25")).where("storeLocation.zip >= 200").count() == 2


def test_attribute_before_the_message(spark):
    lines = spark.createDataFrame([("5\t{\"a\": \"x\ty\"}",), ("no attribute",), ("\t",), (None,)], "value string")
    got = [(r.TIMESTAMP, r.value) for r in split_attribute(lines).collect()]
    assert got == [("5", '{"a": "x\ty"}'), (None, "no attribute"), ("", ""), (None, None)]


def test_micro_batches_follow_the_bytes(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.txt").write_text("x" * 1000 + "\n")
    sizes = []
    from shelfstream.streaming.runs import start_batches

    start_batches(stream_json_lines(spark, str(tmp_path), max_bytes_per_trigger="2100"), lambda batch, load: sizes.append(batch.count()), str(tmp_path / "p")).awaitTermination()
    assert sum(sizes) == 6 and 2 <= len(sizes) and max(sizes) <= 3


def test_jobs_count_parse_failures(spark, tmp_path):
    cfg = RetailConfig(str(tmp_path / "w"))
    stream = as_stream(spark, tmp_path / "in", "value string", [(json.dumps(ARRIVED),), ("{broken",)], [("",), ("{",), (json.dumps(ARRIVED),)])
    stock_plan.start_stock(stream, cfg, str(tmp_path / "p")).awaitTermination()
    got = sorted((r.feed, r.rows, r.json_parse_failures) for r in spark.read.parquet(cfg.table("metrics")).collect())
    assert got == [("stock", 2, 1), ("stock", 3, 2)]
