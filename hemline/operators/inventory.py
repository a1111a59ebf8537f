"""Restock log and stock ledger.

The ledger puts sales and restock events into one table, reduces it with a map-side aggregate to one row
per item, store, date and week, and partitions that once by item and store. Matching, the choice of one
row per date and the running sum are then windows over that one partitioning. A key that holds a third
of all rows reaches its reducer as a handful of partial results, there is no join that could fan out, and
a window sees at most one row per date and week of the calendar, however many rows the input has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.operators.order_stats import running_counts
from hemline.session import written

ITEM_STORE = ["external_code", "retail"]
MILLION = 1_000_000


def sales_for_ledger(silver_sales: DataFrame) -> DataFrame:
    """The ledger's columns of silver sales."""
    return silver_sales.select(
        "external_code",
        "retail",
        F.col("current_week_of_year").alias("week"),
        F.year("current_date_of_week").alias("year"),
        F.col("current_date_of_week").alias("date"),
        "sales",
        "restock",
    )


def _earliest() -> Column:
    """Order of the opening row: dated before undated, then date, week, known and smaller quantity."""
    return F.struct(
        F.col("date").isNull().alias("undated"),
        "date",
        "week",
        F.col("restock").isNull().alias("unknown"),
        F.col("restock").alias("qty"),
        "year",
    )


def initial_stock(sales: DataFrame) -> DataFrame:
    """One opening row per item and store: the one of the earliest date.

    ``sales`` needs external_code, retail, week, year, date, restock.
    """
    return (
        sales.groupBy(*ITEM_STORE)
        .agg(F.min(_earliest()).alias("first"))
        .select(*ITEM_STORE, *[F.col(f"first.{c}").alias(c) for c in ("week", "date", "qty", "year")])
    )


def restock_log(sales: DataFrame, restock: DataFrame) -> DataFrame:
    """Opening stock and restock events in one table, each with a date."""
    events = restock.select(
        *ITEM_STORE, "week", cal.us_week_tuesday("year", "week").alias("date"), "qty", "year"
    )
    return initial_stock(sales).unionByName(events)


def restock_union(sales: DataFrame, restock: DataFrame) -> DataFrame:
    """Opening stock and restock events by week number and year."""
    events = restock.select(*ITEM_STORE, "week", "year", "qty")
    return initial_stock(sales).drop("date").unionByName(events)


def _match_keys(calendar: str) -> list[str]:
    if calendar not in ("parity", "iso"):
        raise ValueError(f"calendar must be 'parity' or 'iso', not {calendar!r}")
    return ["week_start"] if calendar == "iso" else ["week", "year"]


def first_match(sales: DataFrame, restock: DataFrame, calendar: str = "parity") -> DataFrame:
    """One row per item, store and date with the smallest inflow that matches it.

    Ties on the quantity are broken by week and then by the smaller sales figure. Equal to joining all
    sales rows with opening stock and restock events and keeping ``row_number() = 1``. The opening stock
    is read off the series itself, so the sales are scanned once.
    """
    keys = _match_keys(calendar)
    sold = sales.select(*ITEM_STORE, "week", "year", "date", "sales", "restock").withColumn(
        "is_sale", F.lit(True)
    )
    events = restock.select(
        *ITEM_STORE, "week", "year", F.coalesce(F.col("qty"), F.lit(0)).alias("event_qty")
    ).withColumn("is_sale", F.lit(False))
    if calendar == "iso":
        sold = sold.withColumn("week_start", cal.week_start("date"))
        events = events.withColumn("week_start", cal.iso_week_monday("year", "week"))
    steps = ["is_sale", "week", "year", "date", *[k for k in keys if k == "week_start"]]
    rows = (
        sold.unionByName(events, allowMissingColumns=True)
        .groupBy(*ITEM_STORE, *steps)
        .agg(*[F.min(c).alias(c) for c in ("sales", "restock", "event_qty")])
        .repartition(*ITEM_STORE)
    )
    series = Window.partitionBy(*ITEM_STORE)
    same_week = Window.partitionBy(*ITEM_STORE, *keys)
    # The finer window first: its sort order also serves the coarser one.
    matched = (
        rows.withColumn("event_qty", F.min("event_qty").over(same_week))
        .withColumn("first", F.min(F.when(F.col("is_sale"), _earliest())).over(series))
        .filter("is_sale")
    )
    if calendar == "iso":
        opening_week = cal.week_start("first.date") == F.col("week_start")
    else:
        opening_week = (F.col("first.week") == F.col("week")) & (F.col("first.year") == F.col("year"))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*ITEM_STORE, *keys]])
    inflow = F.least(
        F.col("event_qty"), F.when(opening_week, F.coalesce(F.col("first.qty"), F.lit(0)))
    )
    order = Window.partitionBy(*ITEM_STORE, "date").orderBy(
        F.asc("qty"), F.asc_nulls_last("week"), F.asc_nulls_last("sales")
    )
    return (
        matched.withColumn("qty", F.coalesce(F.when(known, inflow), F.lit(0)))
        .withColumn("row", F.row_number().over(order))
        .filter(F.col("row") == 1)
        .select(*ITEM_STORE, "week", "year", "date", "sales", "qty", "row")
    )


def running_balance(df: DataFrame, change: Column, order: str, name: str) -> DataFrame:
    """Running sum per item and store; rows with an equal order value share the sum."""
    return df.withColumn(name, F.sum(change).over(Window.partitionBy(*ITEM_STORE).orderBy(order)))


def stock_ledger(sales: DataFrame, restock: DataFrame, calendar: str = "parity") -> DataFrame:
    """Stock balance per item, store and date.

    ``calendar="parity"`` matches on the week number counted on from the release and the calendar year,
    and runs the sum by that week number. ``calendar="iso"`` matches on the Monday of the ISO week and
    runs by date, so a restock after new year finds its week and the sum follows time.
    """
    matched = first_match(sales, restock, calendar)
    order = "date" if calendar == "iso" else "week"
    return running_balance(matched, F.col("qty") - F.col("sales"), order, "accumulated_inventory")


def unit_benefits(orders: DataFrame, key: list[str], value: Column | None = None) -> DataFrame:
    """(key, benefit, n): how many units of each order have a benefit.

    ``orders`` has one row per ``key`` with ``accumulated_inventory``, ``lo_ci`` and ``hi_ci`` in whole units. A unit lifts the stock by one,
    up to the upper bound. The chance that it is needed is 1 up to the lower bound and falls evenly to the upper one; its benefit is that
    chance in millionths, times ``value`` (a whole number), rounded down. Orders without bounds or need have no units.
    """
    balance, low, high = (F.col(c).cast("long") for c in ("accumulated_inventory", "lo_ci", "hi_ci"))
    need = F.greatest(high - balance, F.lit(0))
    width = F.greatest(high - low, F.lit(1))
    # Units up to the lower bound are alike: one row for all of them, and one for each unit above.
    sure = F.least(need, F.greatest(low - balance, F.lit(0)))
    one = value if value is not None else F.lit(1)

    def benefit(k: Column) -> Column:
        left = F.least(width, high - balance - k + 1)
        total = F.lit(MILLION).cast("long") * left * one
        return ((total - F.pmod(total, width)) / width).cast("long")

    rest = F.when(need > sure, F.transform(F.sequence(sure + 1, need), lambda k: F.struct(benefit(k).alias("benefit"), F.lit(1).cast("long").alias("n"))))
    first = F.when(sure > 0, F.array(F.struct((F.lit(MILLION).cast("long") * one).cast("long").alias("benefit"), sure.alias("n"))))
    none = F.array().cast("array<struct<benefit:bigint,n:bigint>>")
    units = F.concat(F.coalesce(first, none), F.coalesce(rest, none))
    rows = orders.select(*key, F.explode(units).alias("u")).select(*key, "u.benefit", "u.n")
    return rows.groupBy(*key, "benefit").agg(F.sum("n").alias("n"))


def deal_budget(units: DataFrame, key: list[str], budget: int) -> DataFrame:
    """(key, granted): the ``budget`` units of highest benefit, equal ones in the order of ``key``.

    ``units`` has (key, benefit, n). Benefits are counted and running sums taken over ranges of them, which gives the benefit at which the
    budget ends; only the units of that one benefit are then dealt by running sums over ranges of the key. Two numbers reach the driver.
    """
    units = written(units.filter("n > 0"), "units")
    counted = units.groupBy((-F.col("benefit")).alias("order")).agg(F.sum("n").alias("n"))
    edge = running_counts(counted, [], "order", ["n"]).filter((F.col("cum_n") > budget) & (F.col("cum_n") - F.col("n") <= budget)).first()
    if edge is None:
        return units.groupBy(*key).agg(F.sum("n").alias("granted"))
    limit, left = -edge["order"], budget - (edge["cum_n"] - edge["n"])
    above = units.filter(F.col("benefit") > limit).select(*key, "n")
    level = units.filter(F.col("benefit") == limit).select(F.struct(*key).alias("order"), "n")
    ranked = running_counts(level, [], "order", ["n"])
    rest = F.least(F.col("n"), F.greatest(F.lit(left) - (F.col("cum_n") - F.col("n")), F.lit(0)))
    granted = above.unionByName(ranked.select("order.*", rest.alias("n")))
    return granted.groupBy(*key).agg(F.sum("n").alias("granted")).filter("granted > 0")


def reorder_budget(orders: DataFrame, budget: int, key: list[str] | None = None, value: Column | None = None) -> DataFrame:
    """``orders`` with ``granted``: the units of a delivery budget that go to each, by marginal benefit (see :func:`unit_benefits`).

    The sum of ``granted`` is the budget, or all that is needed if that is less.
    """
    key = key or [*ITEM_STORE]
    granted = deal_budget(unit_benefits(orders, key, value), key, budget)
    return orders.join(granted, key, "left").withColumn("granted", F.coalesce("granted", F.lit(0).cast("long")))


def reorder_plan(ledger: DataFrame, forecast: DataFrame) -> DataFrame:
    """Projected stock after the forecast demand of the same item, store and date.

    ``forecast`` needs external_code, retail, ds, forecast, hi_ci. ``order_qty`` raises the stock to the
    upper bound of the interval and is NULL where no forecast is known.
    """
    balance = F.col("accumulated_inventory")
    return (
        ledger.select(*ITEM_STORE, F.col("date").alias("ds"), "accumulated_inventory")
        .join(forecast.select(*ITEM_STORE, "ds", "forecast", "hi_ci"), [*ITEM_STORE, "ds"], "left")
        .withColumns(
            {
                "projected_inventory": balance - F.col("forecast"),
                "stock_out": balance < F.col("forecast"),
                "order_qty": F.when(F.col("hi_ci").isNotNull(), F.greatest(F.col("hi_ci") - balance, F.lit(0))),
            }
        )
    )
