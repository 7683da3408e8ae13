from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.functions.scalars import conform, duration_suffix, parse_event_datetime
from shelfstream.operators import quality
from shelfstream.schemas import CATALOGUE, CLICKSTREAM

ARRIVAL = 1_660_134_397_071  # 2022-08-10 12:26:37.071 UTC
GOOD_TIME = "2022-08-10 12:26:37"


def item(item_id, name="n", brand="b", category="c"):
    return {"item_id": item_id, "item_name": name, "item_brand": brand, "item_category": category}


def events(spark, *rows):
    made = []
    for i, (event, items, when) in enumerate(rows):
        ecommerce = None if items == "none" else {"items": items, "purchase": None}
        made.append({"event": event, "timestamp": i, "event_datetime": when, "ecommerce": ecommerce, "arrival_ms": ARRIVAL})
    full = T.StructType([*CLICKSTREAM.fields, T.StructField("arrival_ms", T.LongType())])
    padded = [{**{n: None for n in full.names}, **r} for r in made]
    for r in padded:
        if r["ecommerce"] and r["ecommerce"]["items"]:
            blank = {f.name: None for f in CLICKSTREAM["ecommerce"].dataType["items"].dataType.elementType}
            r["ecommerce"]["items"] = [{**blank, **it} for it in r["ecommerce"]["items"]]
    return spark.createDataFrame(padded, full)


def catalogue(spark):
    return spark.createDataFrame([("1", "cat name", "cat brand", "cat kind"), ("2", "two", "two b", "two c")], CATALOGUE)


def test_event_datetime_forms(spark):
    df = spark.createDataFrame(
        [(GOOD_TIME,), (GOOD_TIME + "+0200",), (GOOD_TIME + "-01:00",), ("BROKEN DATE FORMAT!!!",), (None,), ("2022-13-10 12:26:37",)],
        "t string",
    )
    base = ARRIVAL - 71
    got = [r.ms for r in df.select(parse_event_datetime(F.col("t")).alias("ms")).collect()]
    assert got == [base, base - 7_200_000, base + 3_600_000, None, None, None]


def test_event_datetime_does_not_follow_the_session_zone(spark):
    df = spark.createDataFrame([(GOOD_TIME,)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(parse_event_datetime(F.col("t"))).first()[0] == ARRIVAL - 71
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_validation_flags(spark):
    df = events(
        spark,
        ("browse", "none", GOOD_TIME),
        ("browse", [item("1", name=None)], GOOD_TIME),
        ("purchase", [item("1")], "BROKEN DATE FORMAT!!!"),
        ("purchase", [item("1"), item("2", brand=None)], "2022-09-09 12:26:37"),
        ("add_to_cart", [item("1", category=None)], GOOD_TIME),
        ("add-to-cart", "none", GOOD_TIME),
        ("purchase", [], GOOD_TIME),
        ("purchase", None, GOOD_TIME),
        ("add_to_cart", "none", GOOD_TIME),
        (None, "none", GOOD_TIME),
    )
    complete, dead = quality.split_missing_items(df, F.timestamp_millis("arrival_ms"))
    checked = quality.flag_bad_event_time(quality.flag_invalid_items(quality.with_errors(complete)), "arrival_ms")
    got = {r.event or "-": (r.errors, r.timestamp) for r in checked.filter("event <> 'purchase' or event is null").collect()}
    assert got["browse"] == ([], ARRIVAL - 71)
    assert got["add_to_cart"] == (["CORR_ITEM"], ARRIVAL - 71)
    assert got["add-to-cart"] == ([], ARRIVAL - 71)
    assert got["-"] == ([], ARRIVAL - 71)
    purchases = sorted((r.timestamp, r.errors) for r in checked.filter("event = 'purchase'").collect())
    assert purchases == [(2, ["CORR_TIME"]), (3, ["CORR_ITEM", "CORR_TIME"])]
    main, faulty = quality.route_by_errors(checked)
    assert main.count() == 4 and sorted(len(r.errors) for r in faulty.collect()) == [1, 1, 2]
    letters = dead.collect()
    assert len(letters) == 3 and {r.error for r in letters} == {quality.MISSING_ITEMS}


def test_items_are_corrected_in_place(spark):
    df = events(
        spark,
        ("purchase", [item("9", name=None), item("2", brand=None), item("1")], GOOD_TIME),
        ("purchase", [item("1")], GOOD_TIME),
        ("browse", "none", "nonsense"),
    )
    clean, dead = quality.validate_and_correct(df, catalogue(spark), "arrival_ms")
    assert clean.columns == df.columns and dead.count() == 0
    rows = {len(r.ecommerce["items"]) if r.ecommerce else 0: r for r in clean.collect()}
    fixed = [(i.item_id, i.item_name, i.item_brand, i.item_category) for i in rows[3].ecommerce["items"]]
    assert fixed == [("9", None, "b", "c"), ("2", "two", "two b", "two c"), ("1", "cat name", "cat brand", "cat kind")]
    assert rows[1].ecommerce["items"][0].item_name == "n"
    assert rows[0].timestamp == ARRIVAL


def test_equal_copies_are_all_kept(spark):
    one = ("purchase", [item("1", name=None), item("1", name=None)], GOOD_TIME)
    df = events(spark, *[one] * 7).withColumn("timestamp", F.lit(1).cast("bigint")).repartition(3)
    clean, _ = quality.validate_and_correct(df, catalogue(spark), "arrival_ms")
    rows = clean.collect()
    assert len(rows) == 7
    assert all([i.item_name for i in r.ecommerce["items"]] == ["cat name", "cat name"] for r in rows)


def test_conform_and_suffix(spark):
    df = spark.createDataFrame([(1, "x")], "count int, page string")
    from shelfstream.schemas import PAGE_VIEW_AGG

    assert tuple(conform(df, PAGE_VIEW_AGG).first()) == (None, None, "x", 1)
    assert [duration_suffix(ms) for ms in (5_000, 600_000, 3_600_000, 5_400_250, 90_000_000)] == ["5S", "10M", "1H", "1H30M250MS", "25H"]
