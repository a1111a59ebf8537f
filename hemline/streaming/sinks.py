"""Sinks: exactly-once appends, replay-safe micro-batches, additive schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COLUMN = "ingest_batch"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listed_in_slices(spark: SparkSession) -> Iterator[None]:
    """Streams that run in here list the files of a micro-batch in as many tasks as the cluster has slots.

    Spark's own default is a task per file, whose report to the driver is many times as large as the file's entry. The sources
    read the setting of the session batch by batch; it is put back at the end.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, min(int(before), max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def append_files(stream: DataFrame, path: str, checkpoint: str, timeout: float | None = None) -> None:
    """Drain the backlog into parquet files and stop.

    The file sink's own log makes a retried batch visible once. Nothing else may write to ``path``:
    readers follow that log and would not see other files.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    with listed_in_slices(stream.sparkSession):
        _wait(writer.trigger(availableNow=True).start(path), timeout)


def append_table(stream: DataFrame, name: str, checkpoint: str, timeout: float | None = None) -> None:
    """As :func:`append_files`, into a table that can be the source of the next stream."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    with listed_in_slices(stream.sparkSession):
        _wait(writer.trigger(availableNow=True).toTable(name), timeout)


def each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    timeout: float | None = None,
) -> None:
    """Drain the backlog through a callback. ``write`` must be safe to repeat for one batch id."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    with listed_in_slices(stream.sparkSession):
        _wait(writer.trigger(availableNow=True).start(), timeout)


def _wait(query, timeout: float | None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not drain within {timeout} seconds")


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch under its id; a replay replaces its own rows and no others."""
    (
        df.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COLUMN)
        .parquet(path)
    )


def append_batch(df: DataFrame, path: str) -> None:
    """Plain batch append; new columns show up when read with :func:`read_merged`."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all files; a column that a file lacks is NULL for its rows."""
    return spark.read.option("mergeSchema", "true").parquet(path)
