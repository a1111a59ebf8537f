"""The feed shapes, built from the warehouse tables of ``TESTDATA.md``.

An item of the weekly panel is a brand, a store is a supplier. An item of the release feeds is a brand
in one block of twelve weeks, counted from a fixed Monday. Its release in a store is the first day with
sales in the block, so every sale falls into one of the twelve weeks from the release and none is left
out. Lines flagged ``R`` are deliveries to the store, all others are sales.

Sums run over whole cents and whole percents, so they are exact in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.operators.reshape import N_WEEKS, week_columns
from hemline.session import written
from hemline.sources.schemas import WEATHER_MEASURES

# Order priorities and the trend columns they feed.
TREND_COLUMNS = {
    "urgent": "1-URGENT",
    "high": "2-HIGH",
    "medium": "3-MEDIUM",
    "not_specified": "4-NOT SPECIFIED",
    "low": "5-LOW",
}


# Length of a release block and the Monday that the blocks are counted from.
BLOCK_DAYS = 7 * N_WEEKS
FIRST_DAY = "1990-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table with the schema that its files have now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, inflow: bool) -> DataFrame:
    """Sold (or delivered) lines with brand number, store, day and whole-number measures."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.substring("p_brand", 7, 10).alias("brand")
    )
    flag = F.col("l_returnflag")
    return (
        table(spark, sf_dir, "lineitem")
        .filter(flag == "R" if inflow else flag != "R")
        .select(
            "l_partkey",
            F.col("l_suppkey").cast("int").alias("retail"),
            F.col("l_shipdate").cast("date").alias("day"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("percent"),
        )
        .join(part, "l_partkey")
        .drop("l_partkey")
    )


def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item, store and ISO week with sales, and the opening stock of the series.

    The opening stock is the sum of the first twelve weeks with sales.
    """
    panel = (
        lines(spark, sf_dir, inflow=False)
        .groupBy(F.col("brand").alias("external_code"), "retail", cal.week_start("day").alias("date"))
        .agg(F.sum("qty").alias("sales"))
    )
    series = Window.partitionBy("external_code", "retail")
    ranked = panel.withColumn("_n", F.row_number().over(series.orderBy("date")))
    return ranked.select(
        "external_code",
        "retail",
        F.weekofyear("date").alias("week"),
        F.year("date").alias("year"),
        "date",
        "sales",
        F.sum(F.when(F.col("_n") <= N_WEEKS, F.col("sales"))).over(series).alias("restock"),
    )


def weekly_restock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries per item, store and ISO week; ``year`` is the year of the Monday."""
    monday = cal.week_start("day")
    return (
        lines(spark, sf_dir, inflow=True)
        .groupBy(
            F.col("brand").alias("external_code"),
            "retail",
            F.weekofyear(monday).alias("week"),
            F.year(monday).alias("year"),
        )
        .agg(F.sum("qty").alias("qty"))
    )


def weekly_restock_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`weekly_restock` with the ISO year."""
    return (
        lines(spark, sf_dir, inflow=True)
        .groupBy(
            F.col("brand").alias("external_code"),
            "retail",
            F.weekofyear("day").alias("week"),
            cal.iso_year("day").alias("year"),
        )
        .agg(F.sum("qty").alias("qty"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of a brand, taken from its part with the smallest key."""
    first = F.min(F.struct("p_partkey", "p_type", "p_name")).alias("first")
    words = F.split("first.p_name", " ")
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.substring("p_brand", 7, 10).alias("brand"))
        .agg(first)
        .select(
            "brand",
            F.lower("first.p_type").alias("category"),
            F.get(words, F.lit(0)).alias("color"),
            F.get(words, F.lit(1)).alias("fabric"),
        )
    )


def release_code(day: Column | str = "day") -> Column:
    """Item of the release feeds: the brand and the number of the block."""
    block = F.floor(F.date_diff(day, F.lit(FIRST_DAY).cast("date")) / BLOCK_DAYS)
    return F.concat("brand", F.lpad(block.cast("string"), 3, "0"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per release and store with the measures of both wide feeds.

    Days are summed on the map side first; the release day and the weeks then follow in one partitioning.
    """
    keys = ["brand", "external_code", "retail"]
    daily = (
        lines(spark, sf_dir, inflow=False)
        .groupBy("brand", release_code().alias("external_code"), "retail", "day")
        .agg(
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
            F.sum("percent").alias("percent"),
            F.count("*").alias("n"),
        )
    )
    dated = daily.withColumn("release", F.min("day").over(Window.partitionBy(*keys)))
    offset = F.floor(F.date_diff("day", "release") / 7).cast("int")

    def in_week(c: str, i: int) -> str:
        return f"sum(CASE WHEN offset = {i} THEN {c} END)"

    weeks = [F.expr(f"coalesce({in_week('qty', i)}, 0) AS w{i}") for i in range(N_WEEKS)]
    discounts = [
        F.expr(f"round(try_divide({in_week('percent', i)}, {in_week('n', i)} * 100), 4) AS d{i}")
        for i in range(N_WEEKS)
    ]
    return dated.withColumn("offset", offset).groupBy(*keys).agg(
        F.min("release").alias("release"),
        F.sum("qty").alias("qty"),
        F.sum("cents").alias("cents"),
        *weeks,
        *discounts,
    )


def wide_sales(spark: SparkSession, sf_dir: str, released: DataFrame | None = None) -> DataFrame:
    """The sales feed: all strings, one column per week since the release.

    ``released`` is :func:`releases`, given where both feeds are built from one copy of it.
    """
    wide = releases(spark, sf_dir) if released is None else released
    half = F.when(F.month("release").between(3, 8), "SS").otherwise("AW")
    season = F.concat(half, F.date_format("release", "yy"))
    # The few brands are stored, so that their size is known and the releases aren't exchanged by a brand.
    brands = written(items(spark, sf_dir), "items")
    return wide.join(brands, "brand", "left").select(
        "external_code",
        F.col("retail").cast("string").alias("retail"),
        season.alias("season"),
        "category",
        "color",
        F.concat(season, F.lit("/"), "external_code", F.lit(".png")).alias("image_path"),
        "fabric",
        F.date_format("release", "yyyy-M-d").alias("release_date"),
        F.col("qty").cast("string").alias("restock"),
        *[F.expr(f"concat(CAST(w{i} AS STRING), '.0') AS `{c}`") for i, c in enumerate(week_columns())],
    )


def wide_price(spark: SparkSession, sf_dir: str, released: DataFrame | None = None) -> DataFrame:
    """The price feed: all strings, mean unit price and the mean discount of each week.

    The price is rounded to whole cents in integer arithmetic.
    """
    wide = releases(spark, sf_dir) if released is None else released
    return wide.select(
        "external_code",
        F.col("retail").cast("string").alias("retail"),
        (F.expr("(2 * cents + qty) div (2 * qty)") / 100).cast("string").alias("price"),
        *[F.expr(f"CAST(d{i} AS STRING) AS `{c}`") for i, c in enumerate(week_columns())],
    )


def customer_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer feed: one text row per line bought, at the order's time."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.date_format("o_orderdate", cal.PURCHASE_TIME_FORMAT).alias("data"),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey",
            F.col("l_suppkey").cast("string").alias("retail"),
            F.col("l_quantity").cast("bigint").cast("string").alias("qty"),
        )
        .join(orders, "l_orderkey")
        .select("data", "retail", "qty")
    )


def restock_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The restock feed of the releases: all strings, calendar year and ISO week."""
    delivered = lines(spark, sf_dir, inflow=True)
    return (
        delivered.groupBy(
            release_code().alias("external_code"),
            F.col("retail").cast("string").alias("retail"),
            F.weekofyear("day").cast("string").alias("week"),
            F.year("day").cast("string").alias("year"),
        )
        .agg(F.sum("qty").alias("q"))
        .select("external_code", "retail", "week", "year", F.col("q").cast("string").alias("qty"))
    )


def trend_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend feed: one row per week and one float column per order priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(cal.week_start(F.col("o_orderdate").cast("date")).alias("date"))
        .agg(
            *[
                F.sum(F.when(F.col("o_orderpriority") == p, 1).otherwise(0)).cast("float").alias(c)
                for c, p in TREND_COLUMNS.items()
            ]
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the weather feed: one row per nation and order day; each measure counts orders of a twelfth of the
    customers."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    counts = [
        F.count_if(F.col("o_custkey") % len(WEATHER_MEASURES) == i).cast("float").alias(c)
        for i, c in enumerate(WEATHER_MEASURES)
    ]
    return (
        orders.join(customer, "o_custkey")
        .join(nation, "c_nationkey")
        .groupBy(F.col("n_name").alias("locality"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
        .agg(*counts)
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".png"))
        .alias("img_path"),
        F.col("embedding").alias("embed"),
    )


def release_embeddings(spark: SparkSession, sf_dir: str, wide: DataFrame) -> DataFrame:
    """A vector per image of the releases in ``wide`` (the sales feed), dealt over all ids of the vectors by a hash of the path."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("embed"))
    ids = vectors.agg(F.min("vec_id").alias("low"), F.max("vec_id").alias("high")).first()
    if ids["low"] is None:
        return vectors.select(F.lit("").alias("img_path"), "embed")
    hashed = F.conv(F.substring(F.md5("image_path"), 1, 8), 16, 10).cast("bigint")
    dealt = hashed % (ids["high"] - ids["low"] + 1) + ids["low"]
    paths = wide.select(F.col("image_path").alias("img_path"), dealt.alias("vec_id")).distinct()
    return paths.join(vectors, "vec_id").select("img_path", "embed")


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary files in the shape of an image feed.

    A page whose length is even becomes a PNG header that carries the length and the page id as width
    and height; the others keep their text, which is no image.
    """
    size = F.length("html")

    def four_bytes(c: Column) -> Column:
        return F.unhex(F.lpad(F.hex(c.cast("bigint")), 8, "0"))

    png = F.concat(
        F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), four_bytes(size), four_bytes(F.col("page_id"))
    )
    path = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, sf_dir, "pages").select(
        F.concat(path, F.lit(".png")).alias("path"),
        F.when(size % 2 == 0, png).otherwise(F.col("html").cast("binary")).alias("content"),
    )


def _bytes_of(c: Column, n: int = 4) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 2 * n, "0"))


def _chunk(name: str, data: Column) -> Column:
    """A PNG chunk: length, name, data and the checksum of the last two."""
    own = F.concat(F.lit(name).cast("binary"), data)
    return F.concat(_bytes_of(F.octet_length(data)), own, _bytes_of(F.crc32(own)))


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole PNG files in the shape of an image feed, one per page: length of the page and page id as width and height, the page's
    text as image data in two chunks."""
    size = F.length("html")
    raw = F.col("html").cast("binary")
    half = F.floor(F.octet_length(raw) / 2).cast("int")
    header = F.concat(_bytes_of(size), _bytes_of(F.col("page_id")), F.unhex(F.lit("0800000000")))
    content = F.concat(
        F.unhex(F.lit("89504E470D0A1A0A")),
        _chunk("IHDR", header),
        _chunk("IDAT", F.substr(raw, F.lit(1), half)),
        _chunk("IDAT", F.substr(raw, half + 1)),
        _chunk("IEND", F.lit("").cast("binary")),
    )
    folder = F.concat(F.lit("p"), (F.col("page_id") % 10).cast("string"))
    path = F.concat_ws("/", F.lit("feed"), folder, F.concat(F.col("page_id").cast("string"), F.lit(".png")))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), content.alias("content"))


def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image files, of which five in seven are cut, changed, without an end, without image data or no image."""
    content, kind = F.col("content"), F.col("page_id") % 7
    size = F.octet_length(content)

    def flipped(at: Column) -> Column:
        other = F.unhex(F.lpad(F.hex(255 - F.conv(F.hex(F.substr(content, at, F.lit(1))), 16, 10).cast("bigint")), 2, "0"))
        return F.concat(F.substr(content, F.lit(1), at - 1), other, F.substr(content, at + 1))

    damaged = (
        F.when(kind == 1, F.substr(content, F.lit(1), size - 14))
        .when(kind == 2, flipped(size - 20))
        .when(kind == 3, flipped(F.lit(30)))
        .when(kind == 4, F.concat(F.substr(content, F.lit(1), F.lit(33)), F.substr(content, size - 11)))
        .when(kind == 5, F.concat(F.lit("GIF89a").cast("binary"), content))
        .otherwise(content)
    )
    return image_files(spark, sf_dir).select("page_id", "path", damaged.alias("content"))
