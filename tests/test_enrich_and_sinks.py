import pytest
from pyspark.sql import functions as F

from shelfstream.operators import enrich
from shelfstream.sinks import append, dead_letter, serving
from shelfstream.streaming.dimension import RefreshingDimension

STORES = [(1, "Irving", "TX", 72712), (1, "Irving", "TX", 72712), (2, "City", "CA", 90000)]
SALES = "store_id int, timestamp long, price float"


def stores(spark):
    return enrich.store_dimension(spark.createDataFrame(STORES, "id long, city string, state string, zip long"))


def test_store_dimension_has_one_row_per_id(spark):
    rows = sorted(tuple(r) for r in stores(spark).collect())
    assert rows == [(1, 72712, "Irving", "TX", 1.0, 1.0), (2, 90000, "City", "CA", 1.0, 1.0)]


def test_unknown_stores_become_letters(spark):
    sales = spark.createDataFrame([(1, 5, 1.0), (7, 6, 2.0), (None, 7, 3.0)], SALES)
    joined = enrich.enrich_with_store(sales, stores(spark))
    assert [r.storeLocation.city for r in enrich.enriched_rows(joined).collect()] == ["Irving"]
    letters = enrich.unknown_store_letters(joined).collect()
    assert sorted(r.error for r in letters) == ["unknown store 7", "unknown store null"]


def test_unknown_store_can_fail_the_job(spark):
    sales = spark.createDataFrame([(7, 6, 2.0)], SALES)
    with pytest.raises(Exception, match="unknown store 7"):
        enrich.enrich_with_store(sales, stores(spark), on_missing="fail").collect()
    with pytest.raises(ValueError):
        enrich.enrich_with_store(sales, stores(spark), on_missing="skip")


def test_dimension_is_read_again_after_its_time(spark, tmp_path):
    path, now = str(tmp_path / "stores"), [0.0]
    columns = "id long, city string, state string, zip long"
    spark.createDataFrame(STORES, columns).write.parquet(path)
    dimension = RefreshingDimension(spark, path, 600, clock=lambda: now[0])
    assert dimension.current().count() == 2
    spark.createDataFrame([(3, "New", "NY", 1)], columns).write.mode("append").parquet(path)
    now[0] = 599.0
    assert dimension.current().count() == 2
    now[0] = 600.0
    assert dimension.current().count() == 3


def test_serving_formats(spark):
    df = spark.createDataFrame([("S-1", "P1", 48, "FAST", "1h", 5)], "store_id string, product_id string, on_hand long, type string, window string, count long")
    assert tuple(serving.format_stock_kv(df).first()) == ("stock:S:1:P1", "48")
    assert tuple(serving.format_signal_kv(df).first()) == ("signal:S:1:P1", "Signal{type='FAST', window='1h', count=5}")


def test_page_view_cells(spark):
    df = spark.createDataFrame([("P1", 1000, 258), (None, 1000, None)], "page string, startTime long, count long")
    got = sorted((r.row_key, r.family, r.qualifier, bytes(r.value)) for r in serving.page_view_cells(df).collect())
    assert got == [
        ("P1-1000", "pageViewAgg", "pageViewCount", (258).to_bytes(8, "big")),
        ("P1-1000", "pageViewAgg", "pageViewRef", b"P1"),
        ("null-1000", "pageViewAgg", "pageViewCount", bytes(8)),
        ("null-1000", "pageViewAgg", "pageViewRef", b""),
    ]


def test_serving_table_versions(spark, tmp_path):
    path = str(tmp_path / "serving")

    def put(rows, load=None):
        df = spark.createDataFrame(rows, "key string, value string, seq long")
        return serving.upsert_latest(df, path, ["key"], ["seq"], load, buckets=1)

    def now(before=None):
        return sorted((r.key, r.value) for r in serving.read_latest(spark, path, ["key"], ["seq"], before).collect())

    assert serving.read_latest(spark, path, ["key"], ["seq"]) is None
    assert put([("a", "1", 1), ("a", "2", 2), ("b", "1", 1)]) == 0
    assert now() == [("a", "2"), ("b", "1")]
    assert put([("a", "3", 3), ("c", "1", 3)]) == 1
    assert now() == [("a", "3"), ("b", "1"), ("c", "1")]
    assert put([("b", "4", 4)]) == 2
    assert put([("b", "0", 0)], "again") == 3
    assert now() == [("a", "3"), ("b", "4"), ("c", "1")]
    assert put([("b", "9", 9)], "again") == 3
    assert now() == [("a", "3"), ("b", "9"), ("c", "1")]
    assert now(before="again") == [("a", "3"), ("b", "4"), ("c", "1")] and now(before="new") == now()
    assert [put([("c", str(i), 10 + i)]) for i in range(3)] == [4, 5, 6]
    assert now() == [("a", "3"), ("b", "9"), ("c", "2")]


def test_serving_writes_follow_the_changed_keys(spark, tmp_path):
    path, n = tmp_path / "serving", 4000
    rows = spark.range(n).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("value"), F.lit(0).cast("long").alias("seq"))

    def written(version):
        files = list(path.glob(f"buckets=*/version={version}@*/kind=*/bucket=*/*.parquet"))
        return {f.parent.name for f in files}, {f.parent.parent.name for f in files}, sum(f.stat().st_size for f in files)

    serving.upsert_latest(rows, str(path), ["key"], ["seq"], buckets=8)
    first = written(0)
    assert len(first[0]) == 8 and first[1] == {"kind=full"}
    for i in range(1, 4):
        changed = spark.createDataFrame([("7", f"v{i}", i)], "key string, value string, seq long")
        serving.upsert_latest(changed, str(path), ["key"], ["seq"], buckets=3)
        buckets, kinds, size = written(i)
        assert len(buckets) == 1 and kinds == {"kind=change"} and size < first[2] / 8
    # All keys change: the changes weigh as much as the snapshots, which the next write then renews.
    for i in (4, 5):
        serving.upsert_latest(rows.withColumn("value", F.lit(f"w{i}")).withColumn("seq", F.lit(i).cast("long")), str(path), ["key"], ["seq"])
    assert written(4)[1] == {"kind=change"} and "kind=full" in written(5)[1]
    latest = serving.read_latest(spark, str(path), ["key"], ["seq"])
    assert latest.count() == n and {r.value for r in latest.select("value").distinct().collect()} == {"w5"}


def test_tasks_of_a_large_serving_table_follow_its_rows(spark, tmp_path, monkeypatch):
    from shelfstream.operators import skew

    monkeypatch.setattr(skew, "TASK_ROWS", 2_000)
    size, advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    before = spark.conf.get(size)
    rows = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.lit(0).cast("long").alias("seq"))
    monkeypatch.setattr(serving, "latest_per_key", lambda df, *more, latest=serving.latest_per_key: (advised.append(df.rdd.getNumPartitions()), latest(df, *more))[1])
    try:
        spark.conf.set(size, "100kb")
        for _ in range(3):
            serving.upsert_latest(rows, str(tmp_path), ["key"], ["seq"], buckets=2, most=40_000)
    finally:
        spark.conf.set(size, before)
    # The newest are found in a task for each 2,000 rows, and no bucket is written by one task.
    assert min(advised) >= 20
    assert all(len(list(b.glob("*.parquet"))) > 2 for b in tmp_path.glob("buckets=2/version=0@*/kind=full/bucket=*"))
    latest = serving.read_latest(spark, str(tmp_path), ["key"], ["seq"])
    assert latest.count() == 40_000 == latest.select("key").distinct().count()


def test_tasks_of_the_join_of_orders_and_lines_follow_the_lines(spark, tmp_path, monkeypatch):
    from shelfstream.operators import skew
    from shelfstream.sources import sample_feeds as feeds

    folder = "/root/testdata/sf0.001"
    want = sorted(map(str, feeds.transactions(spark, folder).collect()))
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    try:
        spark.conf.set(broadcast, "-1")
        got = feeds.transactions(spark, folder)
        assert got.rdd.getNumPartitions() == -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500)
        assert sorted(map(str, got.collect())) == want
    finally:
        spark.conf.set(broadcast, before)


def test_expired_keys_leave_with_the_next_snapshot(spark, tmp_path):
    path = str(tmp_path / "serving")
    for seq in range(3):
        rows = spark.range(200 * seq, 200 * seq + 200).select("id", F.lit(seq).cast("long").alias("seq"))
        serving.upsert_latest(rows, path, ["id"], ["seq"], buckets=1, expired=F.col("seq") < seq - 1)
    assert serving.read_latest(spark, path, ["id"], ["seq"]).agg(F.min("seq")).first()[0] == 1


def test_streaming_appends_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    for _ in range(2):
        append.append_table(df, path, "one")
    append.append_table(df, path, "two")
    assert spark.read.parquet(path).count() == 6
    other = str(tmp_path / "u")
    append.append_table(df, other)
    append.append_table(df, other)
    assert spark.read.parquet(other).count() == 6


def test_raw_archive(spark, tmp_path):
    df = spark.createDataFrame([("{}",), (None,)], "value string")
    assert append.archive_raw(df, str(tmp_path / "raw")) is df
    got = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted(got.columns) == ["date", "json", "load", "processed_timestamp"] and got.count() == 2
    append.archive_raw(df, str(tmp_path / "none"), test_mode=True)
    assert not (tmp_path / "none").exists()


def test_aggregate_path(spark):
    assert append.aggregate_path("w/agg/", "PageView", 5000) == "w/agg/PageView_5S"


def test_dead_letters(spark):
    far = 253_402_300_800_000
    df = spark.createDataFrame([("t", "e", "d", 0), (None, "e", "d", None), ("t", "e", "d", far)], "transform string, error string, data string, ms long")
    letters = df.select("transform", "error", "data", F.timestamp_millis("ms").alias("timestamp"))
    got = [r.ms for r in dead_letter.dead_letter(letters).select(F.unix_millis("timestamp").alias("ms")).collect()]
    assert got == [0, 253_402_214_400_000, 253_402_214_400_000]
    lines = [r.line for r in dead_letter.dead_letter_lines(letters.limit(2)).collect()]
    assert lines == ["d failed with e at 1970-01-01T00:00:00.000Z in t", "d failed with e at null in null"]
