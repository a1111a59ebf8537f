"""Typed, reshaped tables from the raw feeds.

Every function is a chain of narrow projections, so the same code serves a batch and a stream and
never shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.functions import images, text
from hemline.operators.reshape import N_WEEKS, unpivot_weeks, week_columns

RESCUED = "_rescued_data"

# Id columns of the two wide feeds.
SALES_IDS = [
    "external_code",
    "retail",
    "season",
    "category",
    "color",
    "image_path",
    "fabric",
    "release_date",
    "restock",
]
RELEASE_IDS = ["release_day", "release_month", "release_year", "release_week_of_year", "season_category"]
PRICE_IDS = ["external_code", "retail", "price"]


def silver_sales(
    bronze: DataFrame,
    n_weeks: int = N_WEEKS,
    more: list[str] | None = None,
    reshape: Callable[..., DataFrame] = unpivot_weeks,
) -> DataFrame:
    """One typed row per release, store and week. The id columns are parsed before the reshape, once
    per wide row instead of once per week. ``more`` names further columns to keep. A store that is a whole
    number already stays the same column, so a partitioning by it stays known."""
    return weekly_sales(typed_sales(bronze), n_weeks, more, reshape)


def weekly_sales(
    wide: DataFrame,
    n_weeks: int = N_WEEKS,
    more: list[str] | None = None,
    reshape: Callable[..., DataFrame] = unpivot_weeks,
) -> DataFrame:
    """The reshape of :func:`silver_sales`, for rows of :func:`typed_sales`."""
    ids = [*SALES_IDS, *RELEASE_IDS, *(more or [])]
    week = F.col("week").cast("int")
    return reshape(wide, ids, "sales", n_weeks=n_weeks).withColumns(
        {
            "week": week,
            "sales": cal.decimal_text_to_quantity("sales"),
            "current_week_of_year": F.col("release_week_of_year") + week,
            "current_date_of_week": F.date_add("release_date", week * 7),
        }
    )


def typed_sales(bronze: DataFrame) -> DataFrame:
    """The sales feed, still wide, with its id columns parsed."""
    typed = dict(bronze.dtypes)["retail"] == "int"
    return bronze.drop(RESCUED).withColumns(
        {
            "retail": F.col("retail") if typed else cal.text_to_int("retail"),
            "release_day": cal.date_text_part("release_date", 2),
            "release_month": cal.date_text_part("release_date", 1),
            "release_year": cal.date_text_part("release_date", 0),
            "release_date": cal.release_date("release_date"),
            "release_week_of_year": F.weekofyear(cal.release_date("release_date")),
            "restock": cal.text_to_quantity("restock"),
            "season_category": F.substring("season", 1, 2),
        }
    )


def silver_price(bronze: DataFrame, n_weeks: int = N_WEEKS) -> DataFrame:
    wide = bronze.drop(RESCUED).withColumns(
        {"retail": cal.text_to_int("retail"), "price": cal.text_to_float("price")}
    )
    return unpivot_weeks(wide, PRICE_IDS, "discount", n_weeks=n_weeks).withColumns(
        {"week": F.col("week").cast("int"), "discount": cal.text_to_float("discount")}
    )


def silver_priced_sales(sales: DataFrame, price: DataFrame, n_weeks: int = N_WEEKS) -> DataFrame:
    """Silver sales with ``price`` and ``discount``, from both wide feeds.

    Equal to joining the two silver tables by item, store and week, but the rows meet before they are reshaped: what is exchanged is one row
    per item and store, the discounts of all weeks as an array.
    """
    return silver_priced_feed(priced_feed(sales, price, n_weeks), n_weeks)


def priced_feed(sales: DataFrame, price: DataFrame, n_weeks: int = N_WEEKS) -> DataFrame:
    """The sales feed with its store as a whole number, ``price``, and the discounts of all weeks as ``_discounts``."""
    discounts = F.array(*[cal.text_to_float(c) for c in week_columns(n_weeks)])
    typed = price.select(
        F.col("external_code").alias("_code"),
        cal.text_to_int("retail").alias("_retail"),
        cal.text_to_float("price").alias("price"),
        discounts.alias("_discounts"),
    )
    known = sales.withColumn("retail", cal.text_to_int("retail"))
    same = (F.col("external_code") == F.col("_code")) & (F.col("retail") == F.col("_retail"))
    return known.join(typed, same, "left").drop("_code", "_retail")


def silver_priced_feed(
    feed: DataFrame,
    n_weeks: int = N_WEEKS,
    more: list[str] | None = None,
    reshape: Callable[..., DataFrame] = unpivot_weeks,
) -> DataFrame:
    """:func:`silver_sales` of :func:`priced_feed`."""
    rows = silver_sales(feed, n_weeks, ["price", "_discounts", *(more or [])], reshape)
    return rows.withColumn("discount", F.get("_discounts", F.col("week"))).drop("_discounts")


def silver_customer(bronze: DataFrame) -> DataFrame:
    dated = bronze.drop(RESCUED).withColumns(
        {
            "retail": cal.text_to_int("retail"),
            "qty": cal.text_to_quantity("qty"),
            "date": cal.purchase_date("data"),
        }
    )
    return dated.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "weekofyear": F.weekofyear("date"),
        }
    ).drop("data")


def silver_restock(bronze: DataFrame) -> DataFrame:
    return bronze.drop(RESCUED).withColumns(
        {
            "retail": cal.text_to_int("retail"),
            "week": cal.text_to_int("week"),
            "year": cal.text_to_int("year"),
            "qty": cal.text_to_quantity("qty"),
        }
    )


def silver_trends(bronze: DataFrame) -> DataFrame:
    return bronze.drop(RESCUED).withColumns(
        {
            "month": F.month("date"),
            "year": F.year("date"),
            "week_of_year": F.weekofyear("date"),
        }
    )


def silver_images(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "category": text.path_category("path"),
            "file_name": text.path_file_name("path"),
            "size": images.png_size("content"),
        }
    )
