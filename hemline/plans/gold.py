"""Gold tables: features, restock, inventory, image features, forecasts.

Builders take and return DataFrames. Writing is left to ``save_table``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.functions import images, text
from hemline.operators import inventory, joins, silver
from hemline.operators.reshape import explode_weeks
from hemline.session import written


def sales_rows(silver_sales: DataFrame, *more: str) -> DataFrame:
    """Series id, date, target and calendar columns of the feature table, and the columns ``more``."""
    day = F.col("current_date_of_week")
    return silver_sales.select(
        text.series_id().alias("unique_id"),
        day.alias("ds"),
        F.col("sales").alias("y"),
        F.year(day).alias("current_year"),
        F.month(day).alias("current_month"),
        F.weekofyear(day).alias("current_week_of_year"),
        F.col("retail").cast("int").alias("retail"),
        "category",
        "color",
        "fabric",
        "release_year",
        "release_month",
        "release_day",
        F.dayofweek("release_date").alias("release_day_of_week"),
        "release_week_of_year",
        "week",
        "season_category",
        "external_code",
        F.col("image_path").alias("img_path"),
        *more,
    )


def gold_features_of_feeds(
    sales: DataFrame, price: DataFrame, silver_customer: DataFrame, silver_trends: DataFrame, calendar: str = "parity"
) -> DataFrame:
    """:func:`gold_features` from the wide sales and price feeds, whose rows meet each other and the statistics of their store before
    they are reshaped. The rows of a store stay together, so windows along a series need no exchange."""
    stats = written(joins.stats_by_store(joins.customer_week_stats(silver_customer, calendar), calendar), "store-weeks")
    return joins.with_trends(store_rows(sales, price, stats, calendar), silver_trends, calendar)


def store_rows(sales: DataFrame, price: DataFrame, by_store: DataFrame, calendar: str = "parity") -> DataFrame:
    """Feature rows of the wide feeds without the trends; ``by_store`` is ``joins.stats_by_store``."""
    feed = joins.with_store_weeks(silver.priced_feed(sales, price), by_store)
    rows = sales_rows(silver.silver_priced_feed(feed, more=["_by_week"], reshape=explode_weeks), "price", "discount", "_by_week")
    if calendar == "iso":
        rows = rows.withColumn("week_start", cal.week_start("ds"))
    found = joins.from_store_weeks(rows, calendar)
    keys = joins.stats_keys(calendar)
    return found.select(*keys, *[c for c in found.columns if c not in keys])


def gold_features(
    silver_sales: DataFrame,
    silver_price: DataFrame,
    silver_customer: DataFrame,
    silver_trends: DataFrame,
    calendar: str = "parity",
) -> DataFrame:
    """Sales with price, weekly store statistics and weekly trends.

    ``calendar="iso"`` joins the two weekly tables on the Monday of the week, which also matches weeks
    that cross a month or a year. The statistics are written first: Spark then knows their size and
    decides on a broadcast before it would shuffle the sales for the join.
    """
    return _with_weeks(joins.with_price(sales_rows(silver_sales), silver_price), silver_customer, silver_trends, calendar)


def _with_weeks(priced: DataFrame, silver_customer: DataFrame, silver_trends: DataFrame, calendar: str) -> DataFrame:
    """Priced sales rows with the two weekly tables."""
    if calendar == "iso":
        priced = priced.withColumn("week_start", cal.week_start("ds"))
    stats = written(joins.customer_week_stats(silver_customer, calendar), "store-weeks")
    return joins.with_trends(joins.with_customer_stats(priced, stats, calendar), silver_trends, calendar)


def gold_restock(silver_sales: DataFrame, silver_restock: DataFrame) -> DataFrame:
    return inventory.restock_log(inventory.sales_for_ledger(silver_sales), silver_restock)


def gold_inventory(
    silver_sales: DataFrame, silver_restock: DataFrame, calendar: str = "parity"
) -> DataFrame:
    return inventory.stock_ledger(
        inventory.sales_for_ledger(silver_sales), silver_restock, calendar
    )


def gold_image_features(
    silver_images: DataFrame,
    encoder_factory: Callable[[], Callable] | None = None,
    check: Callable[[str], Column] = images.is_png,
) -> DataFrame:
    """Category, file name and image path of the valid images, with an embedding.

    ``check`` says what is valid: a header (``images.is_png``), or a file whole to its last checksum (``images.is_whole_png``).
    ``encoder_factory`` is called once per task and returns a function from a series of byte strings to
    a sequence of float vectors. Without it the table has no embedding column.
    """
    valid = silver_images.filter(F.col("content").isNotNull() & check("content")).select(
        "category", "file_name", text.image_path().alias("img_path"), "content"
    )
    if encoder_factory is None:
        return valid.drop("content")

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder_factory()
        for batch in batches:
            out = batch.drop(columns=["content"])
            out["embed"] = list(encode(batch["content"]))
            yield out

    return valid.mapInPandas(
        embed, "category string, file_name string, img_path string, embed array<float>"
    )


def save_table(df: DataFrame, name: str) -> None:
    """Full refresh; the schema is replaced."""
    df.write.mode("overwrite").saveAsTable(name)
