"""Left joins that build the feature table.

No side carries a broadcast hint. A scanned table is broadcast by its file size and a computed side by
its size at run time, both against ``spark.sql.autoBroadcastJoinThreshold``; above it adaptive execution
splits skewed partitions of the sort-merge join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemline.functions import calendar as cal

STATS = ["retail_total_sales_qty", "retail_total_customer_purchase"]
PRICE_KEYS = ["external_code", "retail", "week"]


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other; the key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def customer_week_stats(customer: DataFrame, calendar: str = "parity") -> DataFrame:
    """Quantity and number of purchases per store and week.

    ``parity`` keys by calendar year and ISO week, so 31 December and 1 January may share a row;
    ``iso`` keys by the Monday of the week.
    """
    counts = [
        F.sum("qty").alias("retail_total_sales_qty"),
        F.count("*").alias("retail_total_customer_purchase"),
    ]
    if calendar == "iso":
        return customer.groupBy("retail", cal.week_start("date").alias("week_start")).agg(*counts)
    return customer.groupBy(
        "retail",
        F.col("year").alias("current_year"),
        F.col("weekofyear").alias("current_week_of_year"),
    ).agg(*counts)


def with_price(sales: DataFrame, price: DataFrame) -> DataFrame:
    return sales.join(price, PRICE_KEYS, "left")


def with_customer_stats(
    sales: DataFrame, stats: DataFrame, calendar: str = "parity"
) -> DataFrame:
    return sales.join(stats, stats_keys(calendar), "left")


def stats_keys(calendar: str = "parity") -> list[str]:
    return ["retail", "week_start"] if calendar == "iso" else ["retail", "current_week_of_year", "current_year"]


def _week_of(calendar: str) -> Column:
    """A week as one value that orders and compares like its join keys."""
    return F.col("week_start") if calendar == "iso" else F.col("current_year") * 100 + F.col("current_week_of_year")


def stats_by_store(stats: DataFrame, calendar: str = "parity") -> DataFrame:
    """:func:`customer_week_stats` as one row per store with a map ``_by_week``, whose size the calendar bounds."""
    known = stats.select("retail", F.struct(_week_of(calendar).alias("week"), F.struct(*STATS).alias("numbers")).alias("entry"))
    known = known.filter(F.col("retail").isNotNull() & F.col("entry.week").isNotNull())
    return known.groupBy("retail").agg(F.map_from_entries(F.collect_list("entry")).alias("_by_week"))


def with_store_weeks(wide: DataFrame, by_store: DataFrame) -> DataFrame:
    """First half of :func:`with_customer_stats` for rows that are reshaped to weeks later: they get the map of their
    store (:func:`stats_by_store`), so one row per item and store is exchanged and not one per week."""
    named = by_store.withColumnRenamed("retail", "_store")
    return wide.join(named, F.col("retail") == F.col("_store"), "left").drop("_store")


def from_store_weeks(rows: DataFrame, calendar: str = "parity") -> DataFrame:
    """Second half: the numbers of the row's own week, taken out of the map."""
    numbers = F.try_element_at("_by_week", _week_of(calendar))
    return rows.withColumns({c: numbers[c] for c in STATS}).drop("_by_week")


def trend_keys(trends: DataFrame, calendar: str = "parity") -> DataFrame:
    """Silver trends with the key names of the feature table."""
    if calendar == "iso":
        return trends.withColumn("week_start", cal.week_start("date")).drop(
            "date", "month", "year", "week_of_year"
        )
    return trends.withColumnsRenamed(
        {"week_of_year": "current_week_of_year", "year": "current_year", "month": "current_month"}
    )


def with_trends(sales: DataFrame, trends: DataFrame, calendar: str = "parity") -> DataFrame:
    """``trends`` is silver trends: one row per week."""
    keys = (
        ["week_start"]
        if calendar == "iso"
        else ["current_week_of_year", "current_month", "current_year"]
    )
    return sales.join(trend_keys(trends, calendar), keys, "left")


def with_features(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Feature columns brought back to a prediction by series and date."""
    return predictions.join(features, ["unique_id", "ds"], "left")


def with_embedding(features: DataFrame, embeddings: DataFrame, key: str = "img_path") -> DataFrame:
    return features.join(embeddings, key, "left")


def keep_series(df: DataFrame, ids: DataFrame, keys: list[str] | str = "unique_id") -> DataFrame:
    """Rows whose key is in the id list; duplicates in the list do not multiply rows."""
    return df.join(ids, keys, "left_semi")
