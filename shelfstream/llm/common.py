"""Helpers shared by the operators: table access, settled frames and batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfstream.session import SHARED_DIR

#: Bytes of text that one vectorized step of a Python task works on; a single longer text is a step of its own.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without one, as in tests, gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="shelfstream-")
        spark.conf.set(SHARED_DIR, root)
    return root.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of ``spark.checkpoint.dir``, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once as a Parquet table in the same folder: for wide frames, of which later steps read some columns."""
    path = f"{shared_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns and the text with null as empty."""
    return df.select(*columns, F.coalesce("text", F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds at most ``most`` bytes, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def map_steps(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
    schema: str | StructType,
    column: str = "text",
    most: int = STEP_BYTES,
) -> DataFrame:
    """``mapInArrow`` with batches cut into steps of bounded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, column, most):
                yield from function(step)

    return df.mapInArrow(run, schema)
