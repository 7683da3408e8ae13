"""Fixed schemas of the feeds and of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of the messages and tables.
ITEM = T.StructType(
    [
        T.StructField("item_name", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("item_brand", T.StringType()),
        T.StructField("item_category", T.StringType()),
        T.StructField("item_category_2", T.StringType()),
        T.StructField("item_category_3", T.StringType()),
        T.StructField("item_category_4", T.StringType()),
        T.StructField("item_category_5", T.StringType()),
        T.StructField("item_variant", T.StringType()),
        T.StructField("item_list_name", T.StringType()),
        T.StructField("item_list_id", T.StringType()),
        T.StructField("index", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
    ]
)

PURCHASE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("transaction_id", "affiliation", "value", "tax", "shipping", "currency", "coupon")
    ]
)

ECOMMERCE = T.StructType(
    [
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("purchase", PURCHASE),
    ]
)

CLICKSTREAM = T.StructType(
    [
        T.StructField("event_datetime", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("page_previous", T.StringType()),
        T.StructField("ecommerce", ECOMMERCE),
    ]
)

STOCK = T.StructType(
    [
        T.StructField("count", T.IntegerType()),
        T.StructField("sku", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("aisleId", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("departmentId", T.IntegerType()),
        T.StructField("price", T.FloatType()),
        T.StructField("recipeId", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

STORE_LOCATION = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("zip", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
    ]
)

TRANSACTION = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("uid", T.IntegerType()),
        T.StructField("order_number", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("time_of_sale", T.LongType()),
        T.StructField("department_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_count", T.IntegerType()),
        T.StructField("price", T.FloatType()),
        T.StructField("storeLocation", STORE_LOCATION),
    ]
)

UNIFIED = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("metadata", T.StringType()),
    ]
)

EVENT_TYPES = ("SALE", "RECEIPT", "SHIPMENT", "RESET", "RETURN", "VIEW", "CART_ADD")

STOCK_AGG = T.StructType(
    [
        T.StructField("durationMS", T.LongType()),
        T.StructField("startTime", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("count", T.LongType()),
    ]
)

PAGE_VIEW_AGG = T.StructType(
    [
        T.StructField("durationMS", T.LongType()),
        T.StructField("startTime", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

SIGNAL = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("window", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

ERROR_MSG = T.StructType(
    [
        T.StructField("transform", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RAW_JSON = T.StructType(
    [
        T.StructField("processed_timestamp", T.TimestampType()),
        T.StructField("json", T.StringType()),
    ]
)

CATALOGUE = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("item_brand", T.StringType()),
        T.StructField("item_category", T.StringType()),
    ]
)
