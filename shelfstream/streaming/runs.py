"""Start a stream, work off what is there and stop."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.session import configure_streaming, shared_dir
from shelfstream.sinks.append import append_table, stream_load
from shelfstream.streaming.keyed_fold import KeyedFold, state_of

#: Rows of a micro-batch that a replayed table is cut into.
SLICE_ROWS = 1_000_000
#: Micro-batches of that size; a table of more rows gets ``SLICE_ROWS`` for each core, as every micro-batch reads and writes state.
SLICES = 8
#: Files of a micro-batch at most.
FILES = 64


def run_to_table(df: DataFrame | KeyedFold, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append everything the stream has now to a parquet table and return that table."""
    spark = _frame(df).sparkSession
    configure_streaming(spark)
    path, checkpoint = path or shared_dir(spark, "table"), checkpoint or shared_dir(spark, "progress")
    if isinstance(df, KeyedFold):
        start_batches(df, lambda rows, load: append_table(rows, path, load), checkpoint).awaitTermination()
        # A stream without any rows has written nothing.
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/load=none")
        return spark.read.schema(df.schema).parquet(path).drop("load")
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _frame(df: DataFrame | KeyedFold) -> DataFrame:
    return df.events if isinstance(df, KeyedFold) else df


def start_batches(df: DataFrame | KeyedFold, work: Callable[[DataFrame, str], None], checkpoint: str, **trigger):
    """Run ``work(batch, load)`` on every micro-batch; ``load`` names the batch of this checkpoint, so a repeat has the same name."""
    configure_streaming(_frame(df).sparkSession)
    stream = stream_load(checkpoint)
    step = df.work(work, state_of(checkpoint)) if isinstance(df, KeyedFold) else work
    return (
        _frame(df)
        .writeStream.foreachBatch(lambda batch, batch_id: step(batch, f"{stream}-{batch_id}"))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def feed(df: DataFrame, time_col: str, slices: int | None = None, closing: dict[str, Column] | None = None) -> DataFrame:
    """A table as a stream in time order: files by ranges of ``time_col`` in one write, and a micro-batch per slice of consecutive files.

    No later file holds an earlier time, and rows of one time stay together. ``closing`` gives the columns of a last row, e.g. a heartbeat beyond all windows that lets the watermark close them; its other columns are null.
    Without ``slices`` there are 4, or more (:func:`slices_of`). The stream takes files by their time of change, which is set
    after the write: the shared folder must be on a file system that keeps such times.
    """
    spark = df.sparkSession
    slices = slices or slices_of(df.count(), spark.sparkContext.defaultParallelism)
    folder = shared_dir(spark, "feed")
    # A file is read by one task, so a slice has several.
    files = min(spark.sparkContext.defaultParallelism, FILES)
    df.repartitionByRange(slices * files, time_col).write.parquet(f"{folder}/0-rows")
    if closing:
        last = [closing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]
        spark.range(1).select(*last).coalesce(1).write.parquet(f"{folder}/1-closing")
    put_in_order(spark, f"{folder}/*/*.parquet")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/*")


def slices_of(rows: int, cores: int) -> int:
    """Number of micro-batches that a table of so many rows is replayed in.

    A keyed stream reads and writes the state of the keys of each micro-batch, so micro-batches of a fixed size would cost a
    growing state as often as the table has such slices. Beyond ``SLICES`` of them, a micro-batch grows with the cores.
    """
    by_size, by_core = -(-rows // SLICE_ROWS), -(-rows // (SLICE_ROWS * cores))
    return max(4, min(by_size, max(SLICES, by_core)))


def put_in_order(spark: SparkSession, pattern: str) -> None:
    """Give the files rising times of change, in the order of their names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in system.globStatus(path)), key=lambda p: p.toString())
    start = int(time.time()) - len(files)
    for i, file in enumerate(files):
        system.setTimes(file, 1000 * (start + i), -1)


def replay(
    df: DataFrame,
    time_col: str,
    run: Callable[[DataFrame, str], None],
    slices: int | None = None,
    closing: dict[str, Column] | None = None,
) -> None:
    """``run(stream, checkpoint)`` on a table as a stream (:func:`feed`); the work of ``run`` is one query on that checkpoint."""
    run(feed(df, time_col, slices, closing), shared_dir(df.sparkSession, "progress"))


def replay_to_table(
    df: DataFrame, time_col: str, plan: Callable[[DataFrame], DataFrame | KeyedFold], slices: int | None = None, closing=None
) -> DataFrame:
    """What ``plan`` makes of the table replayed as a stream, as a table."""
    configure_streaming(df.sparkSession)
    return run_to_table(plan(feed(df, time_col, slices, closing)))
