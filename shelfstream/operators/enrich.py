"""Transactions with the location of their store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.functions.scalars import conform
from shelfstream.schemas import ERROR_MSG, STORE_LOCATION

NO_STORE = "unknown store "


def store_dimension(raw: DataFrame) -> DataFrame:
    """Store table in its full layout, one row per id; coordinates the table lacks are 1."""
    for name in ("lat", "lng"):
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(1.0))
    rows = conform(raw, STORE_LOCATION)
    # Duplicate ids: which one counts is open, so the largest, which is repeatable.
    one = rows.groupBy("id").agg(F.max(F.struct(*[c for c in rows.columns if c != "id"])).alias("rest"))
    return one.select("id", "rest.*")


def enrich_with_store(tx: DataFrame, stores: DataFrame, on_missing: str = "null") -> DataFrame:
    """Add ``storeLocation``; an unknown store leaves it null, or fails the job if ``on_missing="fail"``.

    The optimizer broadcasts the dimension if its bytes allow; otherwise adaptive skew handling splits hot stores.
    """
    dim = stores.select(F.col("id").alias("_store"), F.struct(*STORE_LOCATION.names).alias("storeLocation"))
    base = tx.drop("storeLocation")
    joined = base.join(dim, F.col("store_id") == F.col("_store"), "left")
    if on_missing == "fail":
        message = F.concat(F.lit(NO_STORE), F.coalesce(F.col("store_id").cast("string"), F.lit("null")))
        checked = F.when(F.col("_store").isNull(), F.raise_error(message)).otherwise(F.col("storeLocation"))
        joined = joined.withColumn("storeLocation", checked)
    elif on_missing != "null":
        raise ValueError(f"on_missing must be 'null' or 'fail', not {on_missing!r}")
    return joined.drop("_store")


def enriched_rows(joined: DataFrame) -> DataFrame:
    return joined.filter("storeLocation is not null")


def unknown_store_letters(joined: DataFrame) -> DataFrame:
    """Transactions of unknown stores in the dead-letter layout."""
    message = [c for c in joined.columns if c != "storeLocation"]
    letters = joined.filter("storeLocation is null").select(
        F.lit("enrich_with_store").alias("transform"),
        F.concat(F.lit(NO_STORE), F.coalesce(F.col("store_id").cast("string"), F.lit("null"))).alias("error"),
        F.to_json(F.struct(*message)).alias("data"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )
    return letters.select(*ERROR_MSG.names)
