"""A slowly changing store dimension beside a stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.operators.enrich import enrich_with_store, store_dimension
from shelfstream.schemas import STORE_LOCATION


class RefreshingDimension:
    """The store table at ``path``, read again when the last reading is older than ``ttl_seconds``.

    Use it inside ``foreachBatch``: a stream-static join would keep the first file listing.
    """

    def __init__(self, spark: SparkSession, path: str, ttl_seconds: float = 600, clock: Callable[[], float] = time.monotonic):
        self._spark, self._path, self._ttl, self._clock = spark, path, ttl_seconds, clock
        self._read_at: float | None = None
        self._frame: DataFrame | None = None

    def current(self) -> DataFrame:
        now = self._clock()
        if self._frame is None or now - self._read_at >= self._ttl:
            self._frame = store_dimension(self._spark.read.parquet(self._path))
            self._read_at = now
        return self._frame

    def enrich(self, batch: DataFrame, on_missing: str = "null") -> DataFrame:
        return enrich_with_store(batch, self.current(), on_missing)


class VersionedDimension:
    """Snapshots of the store table, each valid from a time on, in folders ``valid_from=<epoch ms>`` below ``path``.

    Use it inside ``foreachBatch``: every micro-batch lists the snapshots anew and reads those that its own times need, so a
    snapshot counts as soon as it is there, a repeated micro-batch gets the same answer, and an event gets the store as it was
    at its time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def add(self, stores: DataFrame, valid_from: int) -> None:
        """Write a snapshot; one of the same time is replaced."""
        stores.write.mode("overwrite").parquet(f"{self._path}/valid_from={valid_from}")

    def versions(self) -> list[int]:
        done = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path}/valid_from=*/_SUCCESS")
        found = done.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
        return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found or ())

    def enrich(self, batch: DataFrame, time_col: str = "timestamp") -> DataFrame:
        """``batch`` with ``storeLocation`` as valid at ``time_col``; null for unknown stores and before the first snapshot."""
        span = batch.agg(F.min(time_col).alias("low"), F.max(time_col).alias("high")).first()
        known = self.versions()
        begun = [v for v in known if span.high is not None and v <= span.high]
        # The last snapshot before the batch and those that became valid within it.
        needed = begun[max(0, sum(v <= span.low for v in begun) - 1) :] if begun else []
        if not needed:
            return enrich_with_store(batch, self._spark.createDataFrame([], STORE_LOCATION))
        valid = F.lit(None).cast("bigint")
        for version in needed:
            valid = F.when(F.col(time_col) >= version, F.lit(version)).otherwise(valid)
        stores = None
        for version in needed:
            snapshot = store_dimension(self._spark.read.parquet(f"{self._path}/valid_from={version}")).withColumn("_from", F.lit(version))
            stores = snapshot if stores is None else stores.unionByName(snapshot)
        dim = stores.select(F.col("id").alias("_store"), "_from", F.struct(*STORE_LOCATION.names).alias("storeLocation"))
        base = batch.drop("storeLocation").withColumn("_valid", valid)
        same = (F.col("store_id") == F.col("_store")) & (F.col("_valid") == F.col("_from"))
        return base.join(dim, same, "left").drop("_store", "_from", "_valid")
