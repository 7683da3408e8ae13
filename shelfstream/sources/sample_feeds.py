"""Retail feeds derived from the TPC-H-like sample tables, so that every operator runs on real tables.

Each function takes the session and the folder with the parquet tables. ``reader`` lets the same
projections run on a stream: pass ``stream_table`` instead of the default ``batch_table``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstream.operators.skew import spread
from shelfstream.schemas import ITEM, PURCHASE

# The start of the sample time line (2024-01-01 UTC) and the sample's field rules.
T0_MS = 1_704_067_200_000
DAY_MS = 86_400_000
ARRIVAL = ("arrival_ms", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def batch_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, in no order; works for a single file and for a folder of part files."""
    schema = batch_table(spark, sf_dir, name).schema
    # A glob keeps the file source from asking for a partition base folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _line_time() -> Column:
    return F.expr(
        f"{T0_MS} + ((l_orderkey + l_linenumber) % 7) * {DAY_MS} + ((l_orderkey * 13) % 1440) * 60000 + l_linenumber * 1000"
    )


def _product() -> Column:
    return F.expr("l_partkey div 100")


def unified(spark: SparkSession, sf_dir: str, reader=batch_table) -> DataFrame:
    """Unified events from the order lines, with the arrival order columns :data:`ARRIVAL`."""
    event_type = F.expr(
        """case when l_returnflag = 'N' and l_linenumber = 7 then 'RESET'
                when l_returnflag = 'R' then 'RETURN'
                when l_linestatus = 'O' then 'SALE'
                when l_returnflag = 'A' then 'RECEIPT'
                else 'SHIPMENT' end"""
    )
    return (
        reader(spark, sf_dir, "lineitem")
        .select(
            _product().cast("string").alias("product_id"),
            F.expr("l_suppkey % 5").cast("string").alias("store_id"),
            event_type.alias("event_type"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            _line_time().alias("timestamp"),
            F.lit(None).cast("string").alias("metadata"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_shipdate",
        )
        .withColumn("arrival_ms", F.expr("timestamp + ((l_orderkey * 7 + l_linenumber) % 5) * 1200000"))
    )


def clickstream(spark: SparkSession, sf_dir: str, reader=batch_table) -> DataFrame:
    """Clickstream events with ``event_id`` and ``arrival_ms`` beside the message fields."""
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.expr(
        """case event_type when 'view' then 'browse' when 'click' then 'view_item'
                when 'signup' then if(event_id % 2 = 0, 'add-to-cart', 'add_to_cart')
                when 'purchase' then 'purchase' else 'ERROR' end"""
    )
    shown = F.when(F.col("event_id") % 89 == 0, F.expr("ts + interval 30 days")).otherwise(F.col("ts"))
    item = F.struct(
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("N"), F.col("k"))).alias("item_name"),
        F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("X"), F.col("k"))).otherwise(F.col("k").cast("string")).alias("item_id"),
        F.col("value").cast("float").alias("price"),
        F.lit("B").alias("item_brand"),
        F.lit("cat").alias("item_category"),
        *[
            F.lit(None).cast("string").alias(name)
            for name in (
                "item_category_2",
                "item_category_3",
                "item_category_4",
                "item_category_5",
                "item_variant",
                "item_list_name",
                "item_list_id",
            )
        ],
        F.lit(1).alias("index"),
        (F.col("k") % 3 + 1).alias("quantity"),
    )
    items = F.when(F.col("event_id") % 7 != 0, F.array(item)).otherwise(F.array().cast(T.ArrayType(ITEM)))
    purchase = F.lit(None).cast(PURCHASE)
    return (
        reader(spark, sf_dir, "events")
        .withColumn("k", k)
        .select(
            F.when(F.col("event_id") % 97 == 0, "BROKEN DATE FORMAT!!!")
            .otherwise(F.date_format(shown, "yyyy-MM-dd HH:mm:ss"))
            .alias("event_datetime"),
            event.alias("event"),
            millis(F.col("ts")).alias("timestamp"),
            F.when(F.col("event_id") % 83 != 0, F.col("user_id")).alias("user_id"),
            F.concat(F.lit("C"), F.col("user_id")).alias("client_id"),
            F.concat(F.lit("P"), F.col("k") % 10).alias("page"),
            F.concat(F.lit("P"), F.expr("k div 10")).alias("page_previous"),
            F.when(F.col("event_type").isin("signup", "purchase"), F.struct(items.alias("items"), purchase.alias("purchase"))).alias(
                "ecommerce"
            ),
            "event_id",
            millis(F.col("ts")).alias("arrival_ms"),
        )
    )


def clickstream_json(spark: SparkSession, sf_dir: str, reader=batch_table) -> DataFrame:
    """Clickstream messages as JSON lines in ``value``, some of them broken or blank."""
    events = clickstream(spark, sf_dir, reader)
    message = F.to_json(F.struct(*[c for c in events.columns if c not in ("event_id", "arrival_ms")]))
    return events.select(
        F.when(F.col("event_id") % 101 == 0, "{broken").when(F.col("event_id") % 103 == 0, "").otherwise(message).alias("value"),
        "event_id",
        "arrival_ms",
    )


def transactions(spark: SparkSession, sf_dir: str, reader=batch_table) -> DataFrame:
    """Sales of the open order lines with the customer of their order."""
    lines = reader(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'")
    orders = batch_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    if not lines.isStreaming:
        # The tasks of the join follow the lines, which the footers of the files count.
        total = batch_table(spark, sf_dir, "lineitem").count()
        lines, orders = (spread(table, ["l_orderkey"], total) for table in (lines, orders))
    return lines.join(orders, "l_orderkey").select(
        _line_time().alias("timestamp"),
        F.col("o_custkey").cast("int").alias("uid"),
        F.concat_ws("-", F.lit("O"), "l_orderkey", "l_linenumber").alias("order_number"),
        F.col("o_custkey").cast("int").alias("user_id"),
        # Some sales name a store that no table knows.
        F.expr("l_suppkey + if(l_orderkey % 11 = 0, 1000000, 0)").cast("int").alias("store_id"),
        _line_time().alias("time_of_sale"),
        F.col("l_linenumber").cast("int").alias("department_id"),
        _product().cast("int").alias("product_id"),
        F.col("l_quantity").cast("int").alias("product_count"),
        F.col("l_extendedprice").cast("float").alias("price"),
    )


def stock(spark: SparkSession, sf_dir: str, reader=batch_table) -> DataFrame:
    """Stock arrivals: the accepted, fulfilled order lines."""
    return (
        reader(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'A' and l_linestatus = 'F'")
        .select(
            F.col("l_quantity").cast("int").alias("count"),
            F.lit(0).alias("sku"),
            _product().cast("int").alias("product_id"),
            F.col("l_suppkey").cast("int").alias("store_id"),
            F.lit(0).alias("aisleId"),
            F.lit(None).cast("string").alias("product_name"),
            F.col("l_linenumber").cast("int").alias("departmentId"),
            F.lit(None).cast("float").alias("price"),
            F.lit(None).cast("string").alias("recipeId"),
            F.lit(None).cast("string").alias("image"),
            _line_time().alias("timestamp"),
        )
    )


def as_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON line in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension as it lies in the warehouse, without coordinates: the suppliers."""
    nation, region = (batch_table(spark, sf_dir, t) for t in ("nation", "region"))
    return (
        batch_table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            (F.lit(10000) + F.col("s_suppkey")).alias("zip"),
        )
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item texts by id: the parts."""
    return (
        batch_table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").cast("string").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("item_brand"),
            F.col("p_type").alias("item_category"),
        )
    )
