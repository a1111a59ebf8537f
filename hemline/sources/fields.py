"""CSV files whose headers differ, read field by field inside the executors.

Lines come from a text source with the file they are in. The first line of each file is its header, found by a grouped minimum;
every other line is cut into fields, which get their names from the header of their own file by a join. So files may gain, lose or move
columns, no file is opened by the driver, and what reaches it are the distinct column names at most.

A field that fits no declared column, or not its type, is kept by name in a map (``_rescued``), the rest of its row as usual. Rows of one
file have at most one line each: quoted fields may hold commas and quotes, but no line feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemline.sources.files import ANY_AGE, FILES_PER_BATCH, stream_options

RESCUED_FIELDS = "_rescued"
FILE = "_file"
#: A field behind its comma: quoted, with quotes doubled or behind a backslash, or plain.
FIELD = r',("(?:[^"\\]++|\\.|"")*+"(?=,|$)|[^,]*+)'


def _with_file(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def stream_lines(
    spark: SparkSession,
    path: str,
    pattern: str | None = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
    max_age: str = ANY_AGE,
) -> DataFrame:
    """(value, file, block) of the lines of new files."""
    reader = stream_options(spark.readStream, files_per_batch, max_age)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return _with_file(reader.text(path))


def batch_lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return _with_file(reader.text(path))


def split_fields(line: Column) -> Column:
    """The fields of a CSV line; an empty plain field is NULL, an empty quoted one is empty."""

    def plain(raw: Column) -> Column:
        inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
        quoted = (F.length(raw) >= 2) & raw.startswith('"') & raw.endswith('"')
        # A quote is doubled or guarded by a backslash.
        clean = F.regexp_replace(F.regexp_replace(inner, '""', '"'), r'\\(["\\])', "$1")
        return F.when(quoted, clean).when(raw != "", raw)

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD), F.lit(1)), plain)


def _names(header: Column) -> Column:
    """Column names of a header; an empty one is ``_c<i>``, a name that comes again gets its place behind it."""
    named = F.transform(split_fields(header), lambda x, i: F.coalesce(F.trim(x), F.concat(F.lit("_c"), i.cast("string"))))
    return F.transform(
        named,
        lambda x, i: F.when(F.array_position(named, x) == i + 1, x).otherwise(F.concat_ws("_", x, i.cast("string"))),
    )


def fields_by_header(lines: DataFrame) -> DataFrame:
    """(file, fields) of every line but the headers; ``fields`` maps names to texts.

    ``lines`` is as of :func:`batch_lines`. A field that a line lacks is NULL, one beyond the header is ``_c<i>``. Files without lines
    give no rows.
    """
    # A file's lines come in order within its splits, and its first split begins at 0.
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    first = numbered.filter("block = 0").groupBy("file").agg(F.min(F.struct("line", "value")).alias("lead"))
    headers = first.select("file", F.col("lead.line").alias("first"), _names(F.col("lead.value")).alias("names"))
    rows = numbered.join(headers, "file").filter(F.col("line") != F.col("first")).filter(F.col("value") != "")
    values = rows.select("file", "names", split_fields(F.col("value")).alias("values"))
    size = F.greatest(F.size("names"), F.size("values"))
    entry = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            F.coalesce(F.get("names", i), F.concat(F.lit("_c"), i.cast("string"))).alias("key"), F.get("values", i).alias("value")
        ),
    )
    return values.select("file", F.map_from_entries(entry).alias("fields"))


def column_names(fields: DataFrame) -> list[str]:
    """All names that occur, sorted."""
    named = fields.select(F.explode(F.map_keys("fields")).alias("name")).distinct()
    return sorted(r["name"] for r in named.collect())


def typed_rows(fields: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, ``_rescued`` (name: text of the fields that did not fit; NULL if none) and ``_file``."""
    texts = {f.name: F.col("fields")[f.name] for f in schema.fields}
    cast = {f.name: texts[f.name].try_cast(f.dataType) for f in schema.fields}
    known = F.array(*[F.lit(f.name) for f in schema.fields]) if schema.fields else F.array().cast("array<string>")
    unknown = F.map_filter("fields", lambda k, v: ~F.array_contains(known, k) & v.isNotNull())
    misfits = [F.when(cast[n].isNull() & texts[n].isNotNull(), F.struct(F.lit(n).alias("key"), texts[n].alias("value"))) for n in texts]
    wrong = F.map_from_entries(F.array_compact(F.array(*misfits))) if misfits else F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    rescued = F.map_concat(unknown, wrong)
    return fields.select(
        *[cast[n].alias(n) for n in cast],
        F.when(F.size(rescued) > 0, rescued).alias(RESCUED_FIELDS),
        F.col("file").alias(FILE),
    )


def fitting_rows(typed: DataFrame) -> DataFrame:
    """Rows all of whose fields fit, without the two extra columns."""
    return typed.filter(F.col(RESCUED_FIELDS).isNull()).drop(RESCUED_FIELDS, FILE)


def rescued_fields(typed: DataFrame) -> DataFrame:
    """(file, field, value) of every field that did not fit."""
    return typed.select(F.col(FILE).alias("file"), F.explode(RESCUED_FIELDS).alias("field", "value"))
