import json

from pyspark.sql import functions as F

from shelfstream.operators import parse, unify
from shelfstream.schemas import CLICKSTREAM, STOCK, TRANSACTION

CLICK = {
    "uid": 11,
    "sessionId": None,
    "event": "add-to-cart",
    "timestamp": 1700000000123,
    "ecommerce": {"items": [{"item_name": "Kettle", "item_id": "12", "price": 8.5, "quantity": 3}]},
    "user_id": 21,
    "client_id": "c7",
    "page_previous": "start",
    "page": "kettles",
    "event_datetime": "2023-11-14 22:13:20",
}


def lines(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def test_good_and_bad_lines(spark):
    wrong_type = {**CLICK, "user_id": "UID3"}
    df = lines(spark, CLICK, "{broken", "", "   ", None, "null", wrong_type, "[1]")
    parsed = parse.parse_json(df, CLICKSTREAM)
    good = parse.good_rows(parsed).collect()
    assert len(good) == 1 and good[0].page == "kettles" and good[0].ecommerce["items"][0].item_id == "12"
    letters = parse.parse_errors(parsed, F.timestamp_millis(F.lit(1000).cast("bigint")))
    assert letters.columns == ["transform", "error", "data", "timestamp"]
    rows = letters.collect()
    assert len(rows) == 7 and all(r.transform is None and r.timestamp is not None for r in rows)
    assert {r.data for r in rows if r.error == parse.BLANK_ERROR} == {"", "   ", None}


def test_stock_and_transaction_schemas(spark):
    stock = {"count": 1, "sku": 0, "aisleId": 0, "product_name": None, "price": None, "timestamp": 5, "store_id": 1, "product_id": 7}
    row = parse.good_rows(parse.parse_json(lines(spark, stock), STOCK)).first()
    assert (row["count"], row.product_id, row.price) == (1, 7, None)
    sale = {"order_number": "b8", "user_id": 9, "store_id": 1, "time_of_sale": 0, "product_id": 4, "price": 25.0, "order_id": 0}
    row = parse.good_rows(parse.parse_json(lines(spark, sale), TRANSACTION)).first()
    assert (row.order_number, row.price, row.storeLocation) == ("b8", 25.0, None)


def test_failures_are_observed(spark):
    from pyspark.sql import Observation

    seen = Observation("parse")
    parsed = parse.parse_json(lines(spark, CLICK, "{", ""), CLICKSTREAM)
    parsed.observe(seen, F.count("error").alias("n")).count()
    assert seen.get["n"] == 2
    assert parse.observe_failures(parsed).count() == 3


def test_unify_clickstream(spark):
    df = lines(
        spark,
        CLICK,
        {"event": "browse", "timestamp": 7},
        {"event": "view_item", "page": "P2"},
        {"event": "purchase", "page": 5, "timestamp": "9"},
        {"event": "add_to_cart", "page": "P2"},
        {"page": "P2"},
        "{broken",
        '{"event":"browse","page":"P1"',
        "",
    )
    rows = unify.unify_clickstream(df, now_ms=F.lit(123).cast("bigint")).collect()
    assert sorted((r.product_id, r.store_id, r.event_type, r.quantity, r.timestamp, r.metadata) for r in rows) == [
        ("5", "WEB", "SALE", 1, 9, None),
        ("P1", "WEB", "VIEW", 1, 7, None),
        ("P2", "WEB", "VIEW", 1, 123, None),
        ("kettles", "WEB", "CART_ADD", 1, 1700000000123, None),
    ]


def test_unify_stock_reads_loose_numbers(spark):
    df = lines(spark, {"product_id": "12", "store_id": 1.7, "count": -3, "timestamp": 4}, {"product_id": "x"}, "{", "")
    rows = unify.unify_stock(df).collect()
    assert sorted((r.product_id, r.store_id, r.event_type, r.quantity, r.timestamp) for r in rows) == [
        ("0", "0", "RECEIPT", 0, 0),
        ("12", "1", "RECEIPT", -3, 4),
    ]


def test_unify_transactions(spark):
    df = lines(
        spark,
        {"store_id": 1, "product_count": 2, "time_of_sale": 50, "order_number": "o1", "product_id": 10050},
        {"store_id": 3_000_000_000, "product_count": 2},
    )
    rows = unify.unify_transactions(df).collect()
    assert sorted((r.product_id, r.store_id, r.event_type, r.quantity, r.timestamp, r.metadata) for r in rows) == [
        ("10050", "1", "SALE", 2, 50, "o1"),
        ("P_Unknown", "-1294967296", "SALE", 2, 0, ""),
    ]


def test_union_and_key(spark):
    stock = unify.unify_stock(lines(spark, {"product_id": 1, "store_id": 2}))
    sale = unify.unify_transactions(lines(spark, {"product_id": 1, "store_id": 2}))
    assert [r.key for r in unify.with_key(unify.union_events(stock, sale)).collect()] == ["2-1", "2-1"]


def test_only_exact_error_is_dropped(spark):
    df = spark.createDataFrame([("ERROR",), ("ERROR 7",), (None,), ("browse",)], "event string")
    assert unify.drop_error_events(df).count() == 3


def test_only_failed_lines_are_kept_for_the_tables(spark, tmp_path, monkeypatch):
    from shelfstream.config import RetailConfig
    from shelfstream.plans import stock

    kept, computed_once = [], stock.computed_once
    monkeypatch.setattr(stock, "computed_once", lambda df, purpose: kept.append(df) or computed_once(df, purpose))
    lines = spark.createDataFrame([('{"product_id": 1, "count": 2}',), ("{broken",), ("",), (None,)], "value string")
    stock.store_stock(lines, RetailConfig(str(tmp_path)), "one")
    assert sorted(r.value or "" for r in kept[0].collect()) == ["", "", "", "{broken"]
    letters = spark.read.parquet(RetailConfig(str(tmp_path)).letters("stock"))
    assert sorted(r.data or "" for r in letters.collect()) == ["", "", "{broken"]
    assert spark.read.parquet(RetailConfig(str(tmp_path)).table("stock_clean")).select("product_id", "count").collect() == [(1, 2)]
