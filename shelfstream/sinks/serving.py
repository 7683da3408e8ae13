"""Latest value per key: formats and the versioned serving table.

The table is a folder of numbered versions, each written once next to those readers use; Spark's
success marker is what makes a version count. Keys are dealt into a fixed number of buckets, and a
version has files for the buckets it touches only: the changed rows of a bucket, or all its rows
once the changes since the last such snapshot weigh as much as the snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.functions.scalars import event_key, long_bytes
from shelfstream.operators.skew import spread


# Prefixes and formats of the served keys and values, and the cells of a page-view row.
SIGNAL_FORMAT = "Signal{type='%s', window='%s', count=%d}"
CELL_FAMILY, PAGE_CELL, COUNT_CELL = "pageViewAgg", "pageViewRef", "pageViewCount"
CELL_KEYS = ("row_key", "family", "qualifier")

#: Buckets of a new table. Large buckets are written by several tasks, as their bytes ask for.
BUCKETS = 16
#: Bytes that a row of a file has at least, to bound the rows of files.
ROW_BYTES = 16
#: Changes of a bucket beside its snapshot at most, so that readers open a bounded number of files.
MAX_CHANGES = 50


def serving_key(prefix: str) -> Column:
    """``prefix:store:product``; every dash inside the ids becomes a colon too."""
    key = event_key(F.col("store_id"), F.col("product_id"))
    return F.concat(F.lit(f"{prefix}:"), F.replace(key, F.lit("-"), F.lit(":")))


def format_stock_kv(inventory: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return inventory.select(serving_key("stock").alias("key"), F.col("on_hand").cast("string").alias("value"), *keep)


def format_signal_kv(signals: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    value = F.format_string(SIGNAL_FORMAT, "type", "window", "count")
    return signals.select(serving_key("signal").alias("key"), value.alias("value"), *keep)


def page_view_cells(views: DataFrame) -> DataFrame:
    """Page-view counts as cells of a wide row: ``row_key, family, qualifier, value`` (bytes)."""
    page = F.coalesce("page", F.lit(""))
    cells = F.array(
        F.struct(F.lit(PAGE_CELL).alias("qualifier"), F.encode(page, "UTF-8").alias("value")),
        F.struct(F.lit(COUNT_CELL).alias("qualifier"), long_bytes(F.coalesce("count", F.lit(0))).alias("value")),
    )
    # A null page reads "null" in the row key, while its cell is empty.
    row_key = F.concat_ws("-", F.coalesce("page", F.lit("null")), F.coalesce(F.col("startTime").cast("string"), F.lit("null")))
    return views.select(row_key.alias("row_key"), F.lit(CELL_FAMILY).alias("family"), F.explode(cells).alias("cell")).select(
        "row_key", "family", "cell.qualifier", "cell.value"
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The newest row of every key; partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"newest.`{c}`").alias(c) for c in rest]).select(*df.columns)


@dataclass
class _Version:
    load: str
    folder: str
    #: {bucket: (kind, bytes, folder)}
    buckets: dict[int, tuple[str, int, str]] = field(default_factory=dict)


def files(spark: SparkSession, pattern: str) -> list:
    """Status of the files and folders that a path pattern matches."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ())


def _bucket_count(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of the table at ``path``, None before its first version."""
    return next((int(s.getPath().getName().partition("=")[2]) for s in files(spark, f"{path}/buckets=*")), None)


def _versions(spark: SparkSession, path: str) -> dict[int, _Version]:
    """The complete versions with what they hold of each bucket."""
    versions = {}
    for status in files(spark, f"{path}/buckets=*/version=*/_SUCCESS"):
        folder = status.getPath().getParent()
        number, _, load = folder.getName().partition("=")[2].partition("@")
        versions[int(number)] = _Version(load, folder.toString())
    for status in files(spark, f"{path}/buckets=*/version=*/kind=*/bucket=*/*.parquet"):
        folder = status.getPath().getParent()
        bucket, kind = (p.getName().partition("=")[2] for p in (folder, folder.getParent()))
        number = int(folder.getParent().getParent().getName().partition("=")[2].partition("@")[0])
        if number in versions:
            _, held, _ = versions[number].buckets.get(int(bucket), (kind, 0, ""))
            versions[number].buckets[int(bucket)] = (kind, held + status.getLen(), folder.toString())
    return versions


def _remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class _Bucket:
    """What readers need of a bucket: its last snapshot and the changes after it, oldest first."""

    base: int
    sizes: list[int] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)

    @property
    def most(self) -> int:
        """A bound of the rows in its files."""
        return sum(self.sizes) // ROW_BYTES

    @property
    def due(self) -> bool:
        return sum(self.sizes[1:]) >= self.sizes[0] or len(self.sizes) > MAX_CHANGES


def _current(versions: dict[int, _Version]) -> dict[int, _Bucket]:
    found: dict[int, _Bucket] = {}
    for number, version in sorted(versions.items()):
        for bucket, (kind, size, folder) in version.buckets.items():
            if kind == "full" or bucket not in found:
                found[bucket] = _Bucket(number)
            found[bucket].sizes.append(size)
            found[bucket].folders.append(folder)
    return found


def _rows(spark: SparkSession, buckets: list[_Bucket], keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame | None:
    folders = [folder for bucket in buckets for folder in bucket.folders]
    if not folders:
        return None
    rows = spark.read.parquet(*folders)
    if len(folders) == len(buckets):
        return rows
    return latest_per_key(spread(rows, keys, sum(b.most for b in buckets)), keys, order_cols)


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], order_cols: Sequence[str], before_load: str | None = None
) -> DataFrame | None:
    """The newest row of every key in the serving table, with its ``version``; ``order_cols`` as they were written.

    With ``before_load``, what the table held before that load; a load that is not there yet comes last.
    """
    versions = _versions(spark, path)
    end = next((n for n, v in versions.items() if v.load == before_load), None) if before_load else None
    earlier = {n: v for n, v in versions.items() if end is None or n < end}
    return _rows(spark, list(_current(earlier).values()), keys, order_cols)


def upsert_latest(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_cols: Sequence[str],
    load: str | None = None,
    buckets: int = BUCKETS,
    expired: Column | None = None,
    unique: bool = False,
    most: int | None = None,
) -> int:
    """Merge the newest row per key into the serving table; returns the version written.

    Versions count up by themselves, whoever writes. A write costs what changed: a bucket is written whole only once its
    changes weigh as much as its snapshot (or number ``MAX_CHANGES``), and buckets without changes stay as they are. Rows
    that ``expired`` holds for are left out when their bucket is written whole; to come round to all of them, every write then
    renews one bucket in turn. ``buckets`` counts for a new table only. ``unique`` says that ``df`` has one row per key;
    ``most`` is a bound of its rows, which the tasks that look for the newest follow.

    A ``load`` that is written again, as a repeated micro-batch is, replaces its own version. Rows carry their ``version``,
    which ``order_cols`` may name: then later writes win. Otherwise ``order_cols`` are columns of ``df``. Writers of one table
    take turns. A snapshot removes what lies before the one before it, which readers that began earlier may still use.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    buckets = _bucket_count(spark, path) or buckets
    load = load or uuid.uuid4().hex
    number = next((n for n, v in versions.items() if v.load == load), max(versions, default=-1) + 1)
    current = _current({n: v for n, v in versions.items() if n < number})
    due = [b for b, held in current.items() if held.due or (expired is not None and b == number % buckets)]
    rows = df.withColumn("version", F.lit(number).cast("bigint"))
    earlier = _rows(spark, [current[b] for b in due], keys, order_cols)
    if earlier is not None:
        rows = earlier.unionByName(rows)
        most = (most or 0) + sum(current[b].most for b in due)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    newest = rows if unique and earlier is None else latest_per_key(spread(rows, keys, most), keys, order_cols)
    newest = newest.withColumn("bucket", bucket)
    whole = F.col("bucket").isin(due) | ~F.col("bucket").isin(list(current))
    newest = newest.withColumn("kind", F.when(whole, "full").otherwise("change"))
    if expired is not None:
        newest = newest.filter((F.col("kind") == "change") | ~F.coalesce(expired, F.lit(False)))
    target = f"{path}/buckets={buckets}/version={number}@{load}"
    # Small buckets keep together in one file each, large ones are cut by their bytes.
    newest.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("kind", "bucket").parquet(target)
    if expired is not None:
        # A bucket of expired rows only has no file yet that would replace its earlier ones.
        left = {int(s.getPath().getName().partition("=")[2]) for s in files(spark, f"{target}/kind=full/bucket=*")}
        for b in set(due) - left:
            empty = spark.createDataFrame([], newest.drop("kind", "bucket").schema)
            empty.write.mode("overwrite").parquet(f"{target}/kind=full/bucket={b}")
    _remove(spark, [v.buckets[b][2] for n, v in versions.items() for b in due if n < current[b].base and b in v.buckets])
    return number
