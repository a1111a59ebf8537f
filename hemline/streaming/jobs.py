"""Bronze ingest and silver refresh as run-to-completion streams.

Silver transforms are stateless, so they run on the stream itself: the file sink then gives each input
row exactly once without a driver callback.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hemline.operators import silver
from hemline.sources import fields, files, schemas
from hemline.streaming import sinks


@dataclass(frozen=True)
class Feed:
    """A feed: its declared schema (None = taken from the header and kept) and its silver transform."""

    name: str
    schema: T.StructType | None = None
    binary: bool = False
    pattern: str = "*.csv"
    to_silver: Callable[[DataFrame], DataFrame] | None = None


FEEDS = {
    feed.name: feed
    for feed in [
        Feed("clothes", binary=True, pattern="*.png", to_silver=silver.silver_images),
        Feed("customer", to_silver=silver.silver_customer),
        Feed("price", to_silver=silver.silver_price),
        Feed("restock", to_silver=silver.silver_restock),
        Feed("sales", to_silver=silver.silver_sales),
        Feed("gtrends", schema=schemas.TRENDS, to_silver=silver.silver_trends),
        Feed("weather", schema=schemas.WEATHER),
    ]
}


def open_feed(spark: SparkSession, feed: Feed, source: str, state: str) -> DataFrame:
    if feed.binary:
        return files.stream_binary(spark, source, feed.pattern)
    schema = feed.schema or files.tracked_schema(
        spark, source, f"{state}/{feed.name}/schema", feed.pattern
    )
    return files.stream_csv(spark, source, schema, feed.pattern)


def ingest_bronze(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    state: str,
    timeout: float | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Append the new files of a feed to the bronze files at ``target``. A re-run adds no row twice."""
    feed = FEEDS[name]
    feed = replace(feed, schema=schema or feed.schema)
    stream = open_feed(spark, feed, source, state)
    sinks.append_files(stream, target, f"{state}/{name}/bronze", timeout)


def ingest_growing(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    pattern: str = "*.csv",
    files_per_batch: int = 100,
    timeout: float | None = None,
) -> None:
    """Append the new CSV files of a feed whose header may gain, lose or move columns between files.

    The stream carries file names only; each micro-batch reads its files by their own headers and writes them
    under its batch id, so a replay replaces its own rows. Read the result with ``sinks.read_merged``.
    """
    names = files.stream_binary(spark, source, pattern, files_per_batch).select("path")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = files.read_by_header(batch.sparkSession, [r["path"] for r in batch.collect()])
        if rows is not None:
            sinks.write_batch(rows, batch_id, target)

    sinks.each_batch(names, write, f"{state}/growing", timeout)


def ingest_fields(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    schema: T.StructType,
    grow: bool = True,
    pattern: str = "*.csv",
    files_per_batch: int = files.FILES_PER_BATCH,
    timeout: float | None = None,
) -> None:
    """Append the new CSV files of a feed field by field (see ``sources.fields``).

    Columns come by the header of each file, whatever their order. A field that does not fit its declared type is rescued by name, its
    row keeps the others. With ``grow`` columns that the schema lacks are added as texts, without it they are rescued too. No
    file is opened by the driver. Read the result with ``sinks.read_merged``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.persist(StorageLevel.DISK_ONLY)
        parsed = fields.fields_by_header(lines)
        own = schema
        if grow:
            more = [n for n in fields.column_names(parsed) if n not in set(schema.names)]
            own = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in more]])
        sinks.write_batch(fields.typed_rows(parsed, own), batch_id, target)
        lines.unpersist()

    lines = fields.stream_lines(spark, source, pattern, files_per_batch)
    sinks.each_batch(lines, write, f"{state}/fields", timeout)


def quarantine(
    spark: SparkSession, name: str, bronze: str, target: str, state: str, timeout: float | None = None
) -> None:
    """Append the new bronze rows that did not fit their schema, whole, to a table of their own."""
    sinks.append_files(files.rescued_rows(stream_files(spark, bronze)), target, f"{state}/{name}/quarantine", timeout)


def stream_files(spark: SparkSession, path: str, files_per_batch: int = files.FILES_PER_BATCH) -> DataFrame:
    """Stream over the parquet files of an earlier job, with the schema they have."""
    reader = files.stream_options(spark.readStream, files_per_batch)
    return reader.schema(spark.read.parquet(path).schema).parquet(path)


def refresh_silver(
    spark: SparkSession, name: str, bronze: str, target: str, state: str, timeout: float | None = None
) -> None:
    """Append the silver form of the new bronze rows that fit their schema; the others go to :func:`quarantine` only."""
    transform = FEEDS[name].to_silver
    if transform is None:
        raise ValueError(f"feed {name} has no silver table")
    rows = stream_files(spark, bronze)
    stream = transform(files.good_rows(rows) if silver.RESCUED in rows.columns else rows)
    sinks.append_files(stream, target, f"{state}/{name}/silver", timeout)


def refresh_silver_table(
    spark: SparkSession, name: str, bronze_table: str, silver_table: str, state: str
) -> None:
    """The same between catalog tables."""
    stream = FEEDS[name].to_silver(spark.readStream.table(bronze_table))
    sinks.append_table(stream, silver_table, f"{state}/{name}/silver")
