"""Registered queries: every operator run over the whole warehouse tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Doubles are rounded for comparison only here,
never inside an operator.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemline.functions import calendar as cal
from hemline.functions import images, text
from hemline.operators import (
    boosting,
    conformal,
    drift,
    encoding,
    forecast,
    inventory,
    joins,
    metrics,
    profiles,
    quality,
    reduction,
    reshape,
    runs,
    series,
    silver,
)
from hemline.plans import gold
from hemline.session import fresh_path, written
from hemline.sources import binary_files, fields, files, schemas, views
from hemline.streaming import jobs, sinks
from hemline.streaming import ledger as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ITEM_STORE = inventory.ITEM_STORE
TRENDS = list(views.TREND_COLUMNS)
NUMERIC = [*forecast.CUSTOMER, "price", "discount", "retail"]
CATEGORICAL = forecast.CATEGORICAL
EMBED_COLUMNS = [f"embed_{i}" for i in range(1, 65)]
# Releases before this year are the reference (training) side, later ones the current side.
SPLIT_YEAR = 2000
# Coverage that unused rows must reach where 0.85 is asked for, and the trees of the queries that are not about the whole forecast.
COVERED = 0.8
PREDICT_TREES = 20
CHECK_TREES = 60
DIRECTIONS = 8
BACKTEST_TREES = 20


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


# ---- shared frames -------------------------------------------------------------------------------


def sales_long(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_sales(views.wide_sales(spark, d))


def price_long(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_price(views.wide_price(spark, d))


def sales_and_price(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both silver tables from one stored copy of the releases: the lines are scanned and reduced once."""
    released = written(views.releases(spark, d), "releases")
    return (
        silver.silver_sales(views.wide_sales(spark, d, released)),
        silver.silver_price(views.wide_price(spark, d, released)),
    )


def customers(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_customer(views.customer_purchases(spark, d))


def restocks(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_restock(views.restock_events(spark, d))


def trends(spark: SparkSession, d: str) -> DataFrame:
    """The stored silver table, so that its size is known to the joins."""
    return written(silver.silver_trends(views.trend_index(spark, d)), "trends")


def store_stats(spark: SparkSession, d: str) -> DataFrame:
    return written(joins.customer_week_stats(customers(spark, d)), "store-weeks")


def features(spark: SparkSession, d: str, calendar: str = "parity") -> DataFrame:
    """The feature table from both wide feeds, which come from one stored copy of the releases."""
    released = written(views.releases(spark, d), "releases")
    feeds = views.wide_sales(spark, d, released), views.wide_price(spark, d, released)
    return gold.gold_features_of_feeds(*feeds, customers(spark, d), trends(spark, d), calendar)


def monitored(spark: SparkSession, d: str) -> DataFrame:
    """The monitored columns of the feature table; the trend join is not needed for them."""
    stats = written(joins.stats_by_store(joins.customer_week_stats(customers(spark, d))), "store-weeks")
    released = written(views.releases(spark, d), "releases")
    feeds = views.wide_sales(spark, d, released), views.wide_price(spark, d, released)
    return gold.store_rows(*feeds, stats).select(*NUMERIC, *CATEGORICAL, "release_year")


def reference_and_current(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    frame = written(monitored(spark, d), "monitored")
    older = F.col("release_year") < SPLIT_YEAR
    return frame.filter(older).drop("release_year"), frame.filter(~older).drop("release_year")


def weekly(spark: SparkSession, d: str) -> DataFrame:
    """Weekly panel with the key columns of the two weekly joins."""
    return views.weekly_sales(spark, d).select(
        *ITEM_STORE,
        F.col("date").alias("ds"),
        F.col("sales").alias("y"),
        F.col("week").alias("current_week_of_year"),
        F.col("year").alias("current_year"),
        F.month("date").alias("current_month"),
    )


def weekly_signals(spark: SparkSession, d: str) -> DataFrame:
    with_stats = joins.with_customer_stats(weekly(spark, d), store_stats(spark, d))
    return joins.with_trends(with_stats, trends(spark, d)).drop("date")


def naive(spark: SparkSession, d: str) -> DataFrame:
    """Forecast of a week: the mean of the two weeks with sales before it."""
    lagged = series.exog_lags(
        weekly(spark, d), ["y"], (1, 2), key=ITEM_STORE, fill=None, steps="unique"
    )
    mean = (F.col("y_lag1") + F.col("y_lag2")) / F.lit(2.0)
    return (
        lagged.filter(F.col("y_lag2").isNotNull())
        .withColumn("forecast", mean)
        .select(*ITEM_STORE, "ds", "y", "forecast", "current_year", "current_week_of_year")
    )


def calibrated(spark: SparkSession, d: str, by: list[str] | None = None) -> DataFrame:
    """Naive forecasts of the later years with an interval calibrated on the earlier ones."""
    scored = naive(spark, d)
    early = F.col("current_year") < SPLIT_YEAR
    past = conformal.with_residual(scored.filter(early))
    return conformal.with_interval(scored.filter(~early), past, by)


# ---- scalar functions and reshaping --------------------------------------------------------------


@query
def calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    """Purchase time text to date and its calendar parts."""
    day = cal.purchase_date(F.date_format("o_orderdate", cal.PURCHASE_TIME_FORMAT))
    dated = views.table(spark, d, "orders").select("o_orderkey", day.alias("date"))
    return dated.select(
        "o_orderkey",
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.weekofyear("date").alias("weekofyear"),
        F.dayofweek("date").alias("dayofweek"),
        cal.iso_year("date").alias("iso_year"),
        cal.week_start("date").alias("week_start"),
        cal.padded_week(F.weekofyear("date")).alias("padded_week"),
    )


@query
def week_to_date(spark: SparkSession, d: str) -> DataFrame:
    """Restock weeks dated by the Tuesday of the US week."""
    return restocks(spark, d).withColumn("date", cal.us_week_tuesday("year", "week"))


@query
def iso_week_to_date(spark: SparkSession, d: str) -> DataFrame:
    return views.weekly_restock_iso(spark, d).withColumn("date", cal.iso_week_monday("year", "week"))


@query
def series_id(spark: SparkSession, d: str) -> DataFrame:
    rows = sales_long(spark, d)
    return rows.groupBy(text.series_id().alias("unique_id")).agg(
        F.count("*").alias("n_weeks"), F.sum("sales").alias("sales")
    )


@query
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Category and file name of a path."""
    return views.table(spark, d, "pages").select(
        "page_id",
        text.path_category("url").alias("category"),
        text.path_file_name("url").alias("file_name"),
    )


@query
def image_headers(spark: SparkSession, d: str) -> DataFrame:
    """PNG check and size of binary content."""
    size = images.png_size("content")
    return views.page_images(spark, d).select(
        "path",
        images.is_png("content").alias("valid"),
        size["width"].alias("width"),
        size["height"].alias("height"),
    )


@query
def unpivot_sales(spark: SparkSession, d: str) -> DataFrame:
    wide = views.wide_sales(spark, d)
    return reshape.unpivot_weeks(wide, ["external_code", "retail", "release_date"], "sales")


@query
def unpivot_price(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.unpivot_weeks(views.wide_price(spark, d), silver.PRICE_IDS, "discount")
    return long.withColumns({c: r6(c) for c in ("price", "discount")})


@query
def embedding_explode(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.explode_embedding(views.embeddings(spark, d), ["img_path"])
    return rounded(long, "embed_value")


@query
def embedding_columns(spark: SparkSession, d: str) -> DataFrame:
    wide = reshape.embedding_columns(views.embeddings(spark, d), ["img_path"], 64)
    return rounded(wide, *[f"embed_{i + 1}" for i in range(64)])


# ---- silver --------------------------------------------------------------------------------------


@query
def silver_sales(spark: SparkSession, d: str) -> DataFrame:
    return sales_long(spark, d)


@query
def sales_conserved(spark: SparkSession, d: str) -> DataFrame:
    """Units per store after the reshape: every sold unit is in one week of one release."""
    per_release = sales_long(spark, d).groupBy("external_code", "retail").agg(
        F.sum("sales").alias("sales"), F.max("restock").alias("restock")
    )
    return per_release.groupBy("retail").agg(F.sum("sales").alias("sales"), F.sum("restock").alias("restock"))


@query
def silver_price(spark: SparkSession, d: str) -> DataFrame:
    return rounded(price_long(spark, d), "price", "discount")


@query
def silver_customer(spark: SparkSession, d: str) -> DataFrame:
    return customers(spark, d)


@query
def silver_restock(spark: SparkSession, d: str) -> DataFrame:
    return restocks(spark, d)


@query
def silver_trends(spark: SparkSession, d: str) -> DataFrame:
    return rounded(silver.silver_trends(views.trend_index(spark, d)), *TRENDS)


@query
def silver_images(spark: SparkSession, d: str) -> DataFrame:
    typed = silver.silver_images(views.page_images(spark, d))
    return typed.select(
        "path",
        "category",
        "file_name",
        F.col("size.width").alias("width"),
        F.col("size.height").alias("height"),
    )


# ---- joins and aggregates ------------------------------------------------------------------------


@query
def customer_week_stats(spark: SparkSession, d: str) -> DataFrame:
    return joins.customer_week_stats(customers(spark, d))


@query
def customer_week_stats_iso(spark: SparkSession, d: str) -> DataFrame:
    return joins.customer_week_stats(customers(spark, d), "iso")


@query
def price_join(spark: SparkSession, d: str) -> DataFrame:
    sales, price = sales_and_price(spark, d)
    return rounded(joins.with_price(sales.select(*joins.PRICE_KEYS, "sales"), price), "price", "discount")


@query
def customer_stats_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.with_customer_stats(weekly(spark, d), store_stats(spark, d))


@query
def trend_join(spark: SparkSession, d: str) -> DataFrame:
    rows = gold.sales_rows(sales_long(spark, d)).select(
        "external_code", "retail", "ds", "current_week_of_year", "current_month", "current_year"
    )
    return rounded(joins.with_trends(rows, trends(spark, d)), *TRENDS)


@query
def trend_join_iso(spark: SparkSession, d: str) -> DataFrame:
    rows = gold.sales_rows(sales_long(spark, d)).select("external_code", "retail", "ds")
    dated = rows.withColumn("week_start", cal.week_start("ds"))
    return rounded(joins.with_trends(dated, trends(spark, d), "iso"), *TRENDS)


@query
def prediction_feature_join(spark: SparkSession, d: str) -> DataFrame:
    """Predictions with their feature rows brought back by series and date."""
    named = F.concat_ws("-", "external_code", "retail")
    scored = naive(spark, d).select(named.alias("unique_id"), "ds", "forecast")
    rows = weekly(spark, d).withColumn("unique_id", named)
    return joins.with_features(scored, rows)


@query
def embedding_join(spark: SparkSession, d: str) -> DataFrame:
    """Every page image row with all elements of the embedding of the same label path."""
    vectors = views.embeddings(spark, d)
    keyed = views.table(spark, d, "pages").select(
        "page_id",
        F.concat((F.col("page_id") % 10).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".png"))
        .alias("img_path"),
    )
    wide = reshape.embedding_columns(joins.with_embedding(keyed, vectors), ["page_id", "img_path"], 64)
    return rounded(wide, *EMBED_COLUMNS)


@query
def feature_embedding_join(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows joined with the vector of their image, summed up per item with every element."""
    feed = written(views.wide_sales(spark, d), "sales-feed")
    rows = gold.sales_rows(silver.silver_sales(feed)).select("external_code", "img_path", "y")
    joined = joins.with_embedding(rows, written(views.release_embeddings(spark, d, feed), "release-vectors"))
    wide = reshape.embedding_columns(joined, ["external_code", "img_path", "y"], 64)
    sums = [F.max(c).alias(c) for c in EMBED_COLUMNS]
    per_item = wide.groupBy("external_code", "img_path").agg(F.count("*").alias("n"), F.sum("y").alias("y"), *sums)
    return rounded(per_item, *EMBED_COLUMNS)


def release_ids(spark: SparkSession, d: str, test: bool) -> DataFrame:
    late = F.col("release_year") >= SPLIT_YEAR
    rows = gold.sales_rows(sales_long(spark, d))
    return rows.filter(late if test else ~late).select("unique_id").distinct()


@query
def series_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows of the series on the test id list."""
    rows = gold.sales_rows(sales_long(spark, d)).select("unique_id", "ds", "y", "retail")
    return joins.keep_series(rows, release_ids(spark, d, test=True))


@query
def id_list_split(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of a split by id lists that are kept as CSV files. A release has one id, so the lists are made from and matched with
    the wide rows, and only then are these reshaped."""
    base = fresh_path(spark, "id-lists")
    sales = written(silver.typed_sales(views.wide_sales(spark, d)), "typed-sales")
    late, ids = F.col("release_year") >= SPLIT_YEAR, schemas.ID_LIST.names
    for name, side in (("train", ~late), ("test", late)):
        sales.filter(side).select(*ids).distinct().write.option("header", "true").csv(f"{base}/{name}")
    lists = [files.read_ids(spark, f"{base}/{name}") for name in ("train", "test")]
    named = sales.withColumn("unique_id", text.series_id())
    sides = zip(("train", "test"), forecast.split_by_ids(named, *lists), strict=True)
    rows = [gold.sales_rows(silver.weekly_sales(f)).select("unique_id", "ds", "y").withColumn("side", F.lit(n)) for n, f in sides]
    return reduce(DataFrame.unionByName, rows)


@query
def train_test_split(spark: SparkSession, d: str) -> DataFrame:
    rows = gold.sales_rows(sales_long(spark, d)).select("unique_id", "ds", "y")
    past, late = forecast.split_by_ids(
        rows, release_ids(spark, d, test=False), release_ids(spark, d, test=True)
    )
    sides = past.withColumn("side", F.lit("train")).unionByName(late.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count("*").alias("n_rows"), F.sum("y").alias("y"), F.max("ds").alias("last")
    )


@query
def date_split(spark: SparkSession, d: str) -> DataFrame:
    past, late = forecast.split_by_date(weekly(spark, d), f"{SPLIT_YEAR}-01-01")
    sides = past.withColumn("side", F.lit("train")).unionByName(late.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count("*").alias("n_rows"), F.sum("y").alias("y"))


# ---- inventory -----------------------------------------------------------------------------------


@query
def initial_stock(spark: SparkSession, d: str) -> DataFrame:
    return inventory.initial_stock(views.weekly_sales(spark, d))


@query
def restock_union(spark: SparkSession, d: str) -> DataFrame:
    return inventory.restock_union(views.weekly_sales(spark, d), views.weekly_restock(spark, d))


@query
def restock_log(spark: SparkSession, d: str) -> DataFrame:
    return inventory.restock_log(views.weekly_sales(spark, d), views.weekly_restock(spark, d))


@query
def gold_restock(spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_restock(sales_long(spark, d), restocks(spark, d))


@query
def first_match(spark: SparkSession, d: str) -> DataFrame:
    return inventory.first_match(views.weekly_sales(spark, d), views.weekly_restock(spark, d))


@query
def running_balance(spark: SparkSession, d: str) -> DataFrame:
    """Running sum of sales by week number; the years of a week number share the value."""
    rows = views.weekly_sales(spark, d).drop("restock")
    return inventory.running_balance(rows, F.col("sales"), "week", "running_sales")


@query
def inventory_balance(spark: SparkSession, d: str) -> DataFrame:
    return inventory.stock_ledger(views.weekly_sales(spark, d), views.weekly_restock(spark, d))


@query
def inventory_balance_iso(spark: SparkSession, d: str) -> DataFrame:
    return inventory.stock_ledger(views.weekly_sales(spark, d), views.weekly_restock_iso(spark, d), "iso")


@query
def gold_inventory(spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_inventory(sales_long(spark, d), restocks(spark, d))


@query
def inventory_point_filter(spark: SparkSession, d: str) -> DataFrame:
    """One item in one store, through a view and SQL."""
    inventory_balance(spark, d).createOrReplaceTempView("gold_inventory_preview")
    return spark.sql(
        "SELECT * FROM gold_inventory_preview WHERE external_code = '1' AND retail = 3"
    )


@query
def series_point_filter(spark: SparkSession, d: str) -> DataFrame:
    """All weeks of one series, picked by its text id in SQL."""
    gold.sales_rows(sales_long(spark, d)).createOrReplaceTempView("feature_rows")
    return spark.sql(
        "SELECT unique_id, ds, y FROM feature_rows WHERE unique_id = (SELECT min(unique_id) FROM feature_rows)"
    )


@query
def select_expressions(spark: SparkSession, d: str) -> DataFrame:
    """A projection written as SQL strings."""
    return weekly(spark, d).selectExpr(
        "external_code", "retail", "ds", "y * 2 AS doubled", "CASE WHEN y > 30 THEN 'high' ELSE 'low' END AS level"
    )


@query
def inventory_preview(spark: SparkSession, d: str) -> DataFrame:
    """Fifteen rows of the ledger in a fixed order."""
    return inventory_balance(spark, d).orderBy(*ITEM_STORE, "date").limit(15)


@query
def reorder_plan(spark: SparkSession, d: str) -> DataFrame:
    scored = conformal.rounded_forecast(calibrated(spark, d))
    return inventory.reorder_plan(inventory_balance_iso(spark, d), scored)


@query
def reorder_budget(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the units that the last orders of all series need, dealt by marginal benefit."""
    bounds = conformal.rounded_forecast(calibrated(spark, d)).select(*ITEM_STORE, F.col("ds").alias("date"), "lo_ci", "hi_ci")
    known = inventory_balance_iso(spark, d).join(bounds, [*ITEM_STORE, "date"])
    last = known.groupBy(*ITEM_STORE).agg(F.max(F.struct("date", "accumulated_inventory", "lo_ci", "hi_ci")).alias("o"))
    orders = written(last.select(*ITEM_STORE, "o.*"), "orders")
    need = F.sum(F.greatest(F.col("hi_ci").cast("long") - F.col("accumulated_inventory"), F.lit(0)))
    budget = (orders.agg(need.alias("n")).first()["n"] or 0) // 10
    return inventory.reorder_budget(orders, budget).select(*ITEM_STORE, "date", "granted")


# ---- series --------------------------------------------------------------------------------------


@query
def exog_lags(spark: SparkSession, d: str) -> DataFrame:
    columns = [*forecast.CUSTOMER, *TRENDS]
    lagged = series.exog_lags(weekly_signals(spark, d), columns, key=ITEM_STORE, steps="unique")
    names = forecast.lag_names(columns)
    return rounded(lagged.select(*ITEM_STORE, "ds", "y", *names), *names)


@query
def lag_join(spark: SparkSession, d: str) -> DataFrame:
    """Lags of a frame that repeats its steps: sold lines with the store's quantity of earlier days."""
    sold = views.lines(spark, d, inflow=False).select(
        "brand", "retail", F.col("day").alias("ds"), "qty", "cents"
    )
    return series.exog_lags(sold, ["qty"], key=["brand", "retail"], steps="sum")


@query
def target_lag(spark: SparkSession, d: str) -> DataFrame:
    return series.target_lag(weekly(spark, d), key=ITEM_STORE, steps="unique").select(*ITEM_STORE, "ds", "y", "lag1")


@query
def horizon_target(spark: SparkSession, d: str) -> DataFrame:
    out = series.horizon_target(weekly(spark, d), horizon=3, key=ITEM_STORE, steps="unique")
    return out.select(*ITEM_STORE, "ds", "y0", "y1", "y2")


@query
def clip_target(spark: SparkSession, d: str) -> DataFrame:
    """Change to the week before, negative changes clipped."""
    change = series.target_lag(weekly(spark, d), key=ITEM_STORE, steps="unique")
    return series.clip_target(change.select(*ITEM_STORE, "ds", (F.col("y") - F.col("lag1")).alias("y")))


@query
def gold_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features(spark, d), "price", "discount", *TRENDS)


@query
def gold_features_iso(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features(spark, d, "iso"), "price", "discount", *TRENDS)


@query
def model_frame(spark: SparkSession, d: str) -> DataFrame:
    """Model inputs: lagged signals, clipped target, warm-up row dropped."""
    frame = forecast.model_frame(features(spark, d), TRENDS, steps="unique")
    names = forecast.lag_names([*forecast.CUSTOMER, *TRENDS])
    return rounded(frame.select("unique_id", "ds", "y0", "price", "discount", *names), "price", "discount", *names)


@query
def ordinal_codes(spark: SparkSession, d: str) -> DataFrame:
    return encoding.category_codes(
        views.table(spark, d, "part"), ["p_name", "p_brand", "p_type"]
    )


@query
def encoded_items(spark: SparkSession, d: str) -> DataFrame:
    parts = views.table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    codes = encoding.category_codes(parts, ["p_name", "p_type"])
    return encoding.encode(parts, codes, ["p_name", "p_type"]).select(
        "p_partkey", "p_name_code", "p_type_code"
    )


# ---- forecast quality ----------------------------------------------------------------------------


@query
def mdape(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.mdape(naive(spark, d)), "mdape")


@query
def mdape_by_store(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.mdape(naive(spark, d), ["retail"]), "mdape")


@query
def wape(spark: SparkSession, d: str) -> DataFrame:
    """Mean, target-weighted and textbook percentage errors."""
    return naive(spark, d).agg(
        r6(metrics.weighted_ape()).alias("wape"),
        r6(metrics.weighted_ape(weight=F.col("y").cast("double"))).alias("wape_by_target"),
        r6(metrics.total_ape()).alias("total_ape"),
    )


@query
def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.regression_metrics(naive(spark, d))
    return rounded(out, "mae", "mse", "rmse", "r2", "mape", "max_error")


@query
def error_by_store(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.evaluation(naive(spark, d), ["retail"])
    return rounded(out, *[c for c in out.columns if c not in ("retail", "n")])


@query
def error_by_week(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.evaluation(naive(spark, d), ["current_week_of_year"])
    return rounded(out, *[c for c in out.columns if c not in ("current_week_of_year", "n")])


@query
def error_by_category(spark: SparkSession, d: str) -> DataFrame:
    items = views.items(spark, d).select(F.col("brand").alias("external_code"), "category")
    out = metrics.evaluation(naive(spark, d).join(items, "external_code", "left"), ["category"])
    return rounded(out, *[c for c in out.columns if c not in ("category", "n")])


@query
def error_by_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Forecast error by store, week and category in one pass."""
    items = views.items(spark, d).select(F.col("brand").alias("external_code"), "category")
    rows = naive(spark, d).join(items, "external_code", "left")
    dimensions = {"store": F.col("retail"), "week": F.col("current_week_of_year"), "category": F.col("category")}
    out = metrics.evaluation_by_dimensions(rows, dimensions)
    return rounded(out, *[c for c in out.columns if c not in ("dimension", "label", "n")])


@query
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    out = metrics.column_profile(views.table(spark, d, "lineitem"), columns)
    return rounded(out, "min_value", "max_value")


@query
def conformal_interval(spark: SparkSession, d: str) -> DataFrame:
    return calibrated(spark, d).select(*ITEM_STORE, "ds", "y", "forecast", "lo_ci", "hi_ci")


@query
def conformal_by_store(spark: SparkSession, d: str) -> DataFrame:
    return calibrated(spark, d, ["retail"]).select(*ITEM_STORE, "ds", "forecast", "lo_ci", "hi_ci")


@query
def conformal_width(spark: SparkSession, d: str) -> DataFrame:
    """Half-width and calibration size per store."""
    past = conformal.with_residual(naive(spark, d).filter(F.col("current_year") < SPLIT_YEAR))
    return conformal.half_width(past, ["retail"])


@query
def interval_report(spark: SparkSession, d: str) -> DataFrame:
    named = calibrated(spark, d).withColumn("unique_id", F.concat_ws("-", "external_code", "retail"))
    return conformal.interval_report(named)


@query
def interval_coverage(spark: SparkSession, d: str) -> DataFrame:
    return rounded(conformal.coverage(calibrated(spark, d)), "coverage_of_interval")


@query
def rounded_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = conformal.rounded_forecast(calibrated(spark, d))
    return out.select(*ITEM_STORE, "ds", "forecast", "lo_ci", "hi_ci")


@query
def rolling_origin_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Back-test of the naive forecast over the last ten rows of every series."""
    return rounded(forecast.naive_rolling_rmse(naive(spark, d), key=ITEM_STORE, steps="unique"), "rmse")


def store_runs(spark: SparkSession, d: str) -> DataFrame:
    """A runs table: the mean absolute error of every store as one run."""
    scores = metrics.regression_metrics(naive(spark, d), ["retail"])
    return scores.select(
        F.concat(F.lit("store-"), F.col("retail").cast("string")).alias("run_id"),
        F.create_map(F.lit("retail"), F.col("retail").cast("string")).alias("params"),
        F.lit("mean_absolute_error").alias("metric"),
        r6("mae").alias("value"),
    )


@query
def best_run(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "runs")
    runs.log_run(store_runs(spark, d), path)
    best = runs.best_run(runs.read_runs(spark, path), "mean_absolute_error", below=20.0)
    return best.select("run_id", "metric", "value")


@query
def best_score(spark: SparkSession, d: str) -> DataFrame:
    """Best week of the year per store by RMSE, as a score history."""
    history = metrics.regression_metrics(naive(spark, d), ["retail", "current_week_of_year"]).select(
        "retail", F.col("current_week_of_year").alias("iterations"), r6("rmse").alias("score")
    )
    return runs.best_score(history, ["retail"])


# ---- monitoring ----------------------------------------------------------------------------------


@query
def drift_ks(spark: SparkSession, d: str) -> DataFrame:
    out = drift.drift_ks(*reference_and_current(spark, d), NUMERIC)
    return rounded(out.select("column", "statistic", "n_ref", "n_cur", "p_value"), "statistic", "p_value")


@query
def drift_wasserstein(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.drift_wasserstein(*reference_and_current(spark, d), NUMERIC), "statistic")


@query
def drift_js(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.drift_js(*reference_and_current(spark, d), CATEGORICAL), "statistic")


@query
def drift_chi2(spark: SparkSession, d: str) -> DataFrame:
    out = drift.drift_chi2(*reference_and_current(spark, d), CATEGORICAL)
    return rounded(out.select("column", "statistic", "dof", "unseen"), "statistic")


@query
def drift_table(spark: SparkSession, d: str) -> DataFrame:
    out = drift.drift_table(*reference_and_current(spark, d), NUMERIC, CATEGORICAL)
    return rounded(out, "statistic")


@query
def drift_share(spark: SparkSession, d: str) -> DataFrame:
    found = drift.drift_table(*reference_and_current(spark, d), NUMERIC, CATEGORICAL)
    return rounded(drift.drift_share(found), "drift_share")


@query
def missing_by_column(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.missing_by_column(monitored(spark, d)), "missing_share")


@query
def missing_columns(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_columns(monitored(spark, d))


@query
def missing_rows(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.missing_rows(monitored(spark, d)), "missing_row_share")


@query
def constant_columns(spark: SparkSession, d: str) -> DataFrame:
    """Over the weekly panel with a fixed and an empty column added."""
    frame = weekly(spark, d).withColumns(
        {"currency": F.lit("EUR"), "note": F.lit(None).cast("string")}
    )
    return quality.constant_columns(frame)


@query
def duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_rows(monitored(spark, d))


@query
def duplicate_columns(spark: SparkSession, d: str) -> DataFrame:
    """Over sold weeks with a copied column."""
    frame = weekly(spark, d).withColumn("units", F.col("y"))
    return quality.duplicate_columns(frame)


@query
def column_types(spark: SparkSession, d: str) -> DataFrame:
    """Types of the feature table against the raw sales feed, with the number of known values on both sides."""
    ours, theirs = monitored(spark, d), views.wide_sales(spark, d)

    def known(df: DataFrame, name: str) -> DataFrame:
        return quality.missing_by_column(df).select("column", (F.col("n_rows") - F.col("n_missing")).alias(name))

    types = quality.column_types(ours, theirs)
    return types.join(known(ours, "n_reference"), "column", "left").join(known(theirs, "n_current"), "column", "left")


@query
def numeric_health(spark: SparkSession, d: str) -> DataFrame:
    out = quality.numeric_health(*reference_and_current(spark, d), NUMERIC)
    return rounded(out, "out_of_range_share", "mean_cur", "mean_ref", "std_ref", "mean_sigmas")


@query
def out_of_list(spark: SparkSession, d: str) -> DataFrame:
    out = quality.out_of_list(*reference_and_current(spark, d), CATEGORICAL)
    return rounded(out, "out_of_list_share")


def _drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    return drift.drift_table(reference, current, NUMERIC, CATEGORICAL)


@query
def drift_auto(spark: SparkSession, d: str) -> DataFrame:
    """Drift by the method that fits each column's type, values and size."""
    found = drift.drift_auto(*reference_and_current(spark, d), NUMERIC, CATEGORICAL)
    return rounded(found.select("column", "method", "statistic", "drifted"), "statistic")


@query
def drift_small(spark: SparkSession, d: str) -> DataFrame:
    """Accounts of suppliers against those of customers: a number, a category, and one of two values."""
    def accounts(name: str, p: str) -> DataFrame:
        balance = F.col(f"{p}_acctbal").cast("double")
        return views.table(spark, d, name).select(
            balance.alias("balance"), F.col(f"{p}_nationkey").cast("string").alias("nation"), (balance < 0).cast("string").alias("debt")
        )

    found = drift.drift_auto(accounts("supplier", "s"), accounts("customer", "c"), ["balance"], ["nation", "debt"])
    return rounded(found.select("column", "method", "statistic", "drifted"), "statistic")


@query
def profile_drift(spark: SparkSession, d: str) -> DataFrame:
    """Drift against stored profiles, one per month, merged without the rows; beside the exact statistics."""
    frame = written(monitored(spark, d), "monitored")
    counts = written(profiles.counted(frame, ["release_year"], NUMERIC, CATEGORICAL), "profile-counts")
    stored = written(profiles.profiles(frame, ["release_year"], NUMERIC, CATEGORICAL, counts=counts), "profiles")
    older = F.col("release_year") < SPLIT_YEAR
    reference, current = (profiles.merged(stored.filter(side)) for side in (older, ~older))
    found = profiles.compared(reference, current)
    numbers, labels = (profiles.sides(counts, older, kind) for kind in (profiles.NUMBERS, profiles.LABELS))
    exact = written(
        drift.drift_ks(frame.filter(older), frame.filter(~older), NUMERIC, numbers)
        .select("column", "statistic")
        .unionByName(drift.drift_js(frame.filter(older), frame.filter(~older), CATEGORICAL, labels).select("column", "statistic")),
        "exact",
    )
    near = F.abs(F.col("statistic") - F.col("exact")) <= F.col("bound")
    return found.join(exact.withColumnRenamed("statistic", "exact"), "column").select(
        "column", "method", "n_ref", "n_cur", "nulls_ref", "nulls_cur", near.alias("near"), rounded_mean("mean_ref"), rounded_mean("mean_cur")
    )


@query
def stability_suite(spark: SparkSession, d: str) -> DataFrame:
    reference, current = reference_and_current(spark, d)
    return rounded(
        quality.stability_suite(reference, current, _drift(reference, current)), "value", "threshold"
    )


@query
def no_target_suite(spark: SparkSession, d: str) -> DataFrame:
    reference, current = reference_and_current(spark, d)
    checks = quality.no_target_suite(
        reference, current, NUMERIC, CATEGORICAL, _drift(reference, current)
    )
    return rounded(checks, "value", "threshold")


@query
def report_json(spark: SparkSession, d: str) -> DataFrame:
    """Every check as a JSON text; numbers are written with six places."""
    places = {c: F.when(F.col(c).isNotNull(), F.format_string("%.6f", c)) for c in ("value", "threshold")}
    return quality.report_json(no_target_suite(spark, d).withColumns(places))


# ---- image features, models, streams -------------------------------------------------------------


@query
def gold_image_features(spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_image_features(silver.silver_images(views.page_images(spark, d)))


@query
def image_faults(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each file of a feed whose files are partly cut, changed or no images."""
    return views.damaged_files(spark, d).select("path", images.png_fault("content").alias("fault"))


@query
def verified_images(spark: SparkSession, d: str) -> DataFrame:
    """Image features of the files that are whole."""
    typed = silver.silver_images(views.damaged_files(spark, d))
    return gold.gold_image_features(typed, check=images.is_whole_png)


def last_bytes():
    """A small encoder for the embedding hook: the values of an image's last four bytes."""

    def encode(contents):
        for content in contents:
            yield [float(b) for b in content[-4:]]

    return encode


@query
def image_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """The embedding hook with a stand-in encoder."""
    out = gold.gold_image_features(silver.silver_images(views.page_images(spark, d)), last_bytes)
    return rounded(reshape.embedding_columns(out, ["img_path"], 4), *EMBED_COLUMNS[:4])


def rounded_mean(c: str) -> Column:
    return F.round(c, 4).alias(c)


@dataclass
class Trial:
    """A model with the rows it was trained on, calibrated on and is to forecast."""

    model: forecast.DemandModel
    old: DataFrame
    held_out: DataFrame
    late: DataFrame


def _trial(
    spark: SparkSession, d: str, kind: str, params: dict | None = None, vectors: DataFrame | None = None
) -> Trial:
    """Train on the older releases, calibrate on the year before the split, forecast the later ones.

    ``vectors`` (img_path, embed) are reduced and joined as inputs.
    """
    numeric = forecast.numeric_columns(TRENDS)
    needed = [*series.SERIES, "unique_id", "ds", "y0", *numeric, *CATEGORICAL, *(["img_path"] if vectors is not None else [])]
    rows = forecast.model_frame(features(spark, d), TRENDS, steps="unique").select(*dict.fromkeys(needed))
    if vectors is not None:
        reduced = reduction.fit_reduction(vectors, "embed", DIRECTIONS).transform(vectors, "embed")
        none = F.array(*[F.lit(0.0)] * DIRECTIONS)
        rows = joins.with_embedding(rows, reduced).withColumn("embed", F.coalesce("embed", none))
    frame = written(rows, "model-frame")
    year = F.col("release_year")
    old, held_out = frame.filter(year < SPLIT_YEAR - 1), frame.filter(year == SPLIT_YEAR - 1)
    model = forecast.train(old, numeric, kind, params, embed="embed" if vectors is not None else None)
    return Trial(model, old, held_out, frame.filter(year >= SPLIT_YEAR))


def _trained(spark: SparkSession, d: str, kind: str, params: dict | None = None) -> DataFrame:
    trial = _trial(spark, d, kind, params)
    return forecast.forecast_table(trial.model, trial.late, trial.held_out)


def _deviance(scored: DataFrame) -> float:
    return scored.agg(metrics.tweedie_deviance("y0", "forecast", forecast.TWEEDIE_POWER)).first()[0]


def _checks(trial: Trial, kind: str) -> DataFrame:
    """What must hold for a forecast: one row per row, bounds around it, the coverage that was asked for on rows that did not set the
    bounds, and a lower deviance than that of the mean of the training rows."""
    scored = trial.model.score(trial.late)
    known = written(conformal.with_residual(trial.model.score(trial.held_out), "y0"), "held-out")
    sets = F.pmod(F.xxhash64("unique_id"), F.lit(2)) == 0
    residuals = known.filter(sets)
    bounds = conformal.with_interval(scored, residuals)
    width = 2 * conformal.half_width(residuals).first()["q"]
    off = F.abs(F.col("hi_ci") - F.col("lo_ci") - width) > 1e-6 * (1 + width)
    within = F.avg(F.when(F.abs(F.col("y0") - F.col("forecast")) <= width / 2 + 1e-9, 1.0).otherwise(0.0))
    mean = trial.old.agg(F.avg(F.col("y0").cast("double"))).first()[0]
    constant = _deviance(trial.late.withColumn("forecast", F.lit(mean)))
    return bounds.agg(
        F.count("forecast").alias("n_rows"), (F.count_if(off) == 0).alias("bounds_are_twice_the_quantile")
    ).select(
        F.lit(kind).alias("model"),
        "n_rows",
        "bounds_are_twice_the_quantile",
        F.lit(known.filter(~sets).agg(within).first()[0] >= COVERED).alias("covers"),
        F.lit(_deviance(scored) < constant).alias("beats_constant"),
    )


@query
def tweedie_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the Tweedie forecast; at the optimum the score of the intercept is zero over the training rows."""
    trial = _trial(spark, d, "tweedie")
    mu, power = F.col("forecast"), forecast.TWEEDIE_POWER
    score = F.sum((F.col("y0") - mu) * F.pow(mu, F.lit(1 - power))) / F.sum(F.pow(mu, F.lit(2 - power)))
    balance = trial.model.score(trial.old).agg(score).first()[0]
    return _checks(trial, "tweedie").withColumn("intercept_is_optimal", F.lit(abs(balance) < 1e-4))


@query
def tree_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the boosted forecast; the values of the last tree's leaves balance the gradients of their rows."""
    trial = _trial(spark, d, "boosted", {"trees": CHECK_TREES})
    forest = trial.model.regressor
    rows = trial.model.preparation.arrays(trial.old.filter(F.col("y0").isNotNull())).select("features", "y0")
    sums = forest.leaf_sums(rows, len(forest.trees) - 1).collect()
    off = max(abs(r["value"] - boosting.leaf_value(r["g"], r["h"], forest.params)) for r in sums)
    return _checks(trial, "boosted").withColumn("leaves_balance", F.lit(off < 1e-6))


@query
def sql_predict(spark: SparkSession, d: str) -> DataFrame:
    """Forecasts of boosted trees by a SQL function, beside those of the model."""
    trial = _trial(spark, d, "boosted", {"trees": PREDICT_TREES})
    name = f"predict_{uuid.uuid4().hex}"
    forecast.register_predict(spark, trial.model, name)
    inputs = trial.model.regressor.transform(trial.model.preparation.arrays(trial.late))
    same = f"abs({name}(features) - forecast) <= 1e-9 * forecast AS same"
    return spark.sql(f"SELECT unique_id, ds, y0, {same} FROM {{inputs}}", inputs=inputs)


def _backtest(spark: SparkSession, d: str, kind: str, trials: list[dict]) -> DataFrame:
    """Rows and scores of every trial and window, beside the spread of the window's targets."""
    frame = written(forecast.model_frame(features(spark, d), TRENDS, steps="unique"), "model-frame")
    scores = forecast.rolling_origin(frame, forecast.numeric_columns(TRENDS), trials, kind=kind, steps="unique")
    known = series.steps_from_end(frame.filter(F.col("y0").isNotNull()), name="window", steps="unique")
    spread = known.filter(F.col("window") <= forecast.N_WINDOWS).groupBy("window").agg(F.stddev_pop("y0").alias("spread"))
    return scores.join(spread, "window").select("trial", "window", "n", (F.col("score") < F.col("spread")).alias("beats_mean"))


@query
def tweedie_backtest(spark: SparkSession, d: str) -> DataFrame:
    """Five linear trials over ten windows, all fitted together."""
    return _backtest(spark, d, "tweedie", forecast.sample_params(forecast.TWEEDIE_SPACE, forecast.N_TRIALS))


@query
def tree_backtest(spark: SparkSession, d: str) -> DataFrame:
    """Two trials of boosted trees over ten windows, grown together for a number of trees that is a parameter here."""
    trials = [{**t, "trees": BACKTEST_TREES} for t in forecast.sample_params(forecast.BOOSTED_SPACE, 2)]
    return _backtest(spark, d, "boosted", trials)


@query
def reduction_checks(spark: SparkSession, d: str) -> DataFrame:
    """Variance of the vectors, and whether what eight directions leave of it is what they leave of the vectors."""
    vectors = views.table(spark, d, "embeddings")
    made = reduction.fit_reduction(vectors, "embedding", DIRECTIONS)
    left, total = made.residual(vectors, "embedding"), float(made.variances.sum())
    sums = bool(abs(left - made.variances[DIRECTIONS:].sum()) <= 1e-9 * total)
    return spark.createDataFrame([(made.rows, round(total, 6), sums, left < total)], "n long, variance double, sums boolean, less boolean")


@query
def vector_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of a forecast that gets the image vectors, reduced to their leading directions, as inputs."""
    vectors = views.release_embeddings(spark, d, written(views.wide_sales(spark, d), "sales-feed"))
    trial = _trial(spark, d, "tweedie", vectors=written(vectors, "release-vectors"))
    assert trial.model.preparation.embed == "embed"
    return _checks(trial, "vectors")


@query
def forecast_stored(spark: SparkSession, d: str) -> DataFrame:
    """The forecast table saved as a table, and its rows that have a forecast within its bounds."""
    name = f"gold_forecasted_{uuid.uuid4().hex}"
    gold.save_table(_trained(spark, d, "tweedie"), name)
    sound = (F.col("forecast") >= F.col("lo_ci")) & (F.col("forecast") <= F.col("hi_ci"))
    return spark.table(name).filter(sound).select("unique_id", "ds", "y0")


@query
def tweedie_forecast(spark: SparkSession, d: str) -> DataFrame:
    return _trained(spark, d, "tweedie").select(
        "unique_id", "ds", "y0", "forecast", "lo_ci", "hi_ci"
    )


@query
def tree_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = _trained(spark, d, "boosted")
    return out.select("unique_id", "ds", "y0", "forecast", "lo_ci", "hi_ci")


@query
def parameter_search(spark: SparkSession, d: str) -> DataFrame:
    """Five trials over ten back-test windows."""
    frame = forecast.model_frame(features(spark, d), TRENDS, steps="unique")
    found = forecast.search(frame, forecast.numeric_columns(TRENDS), steps="unique")
    return found.select("trial", "n_windows", "score")


def _ingested(
    spark: SparkSession, name: str, df: DataFrame, by: str, schema: T.StructType | None = None
) -> str:
    """A feed as CSV files that arrive in two rounds, then a run without new files; the folder with its tables.

    The second round holds the rows whose hash of ``by`` is odd.
    """
    base = fresh_path(spark, f"ingest-{name}")
    late = F.pmod(F.xxhash64(by), F.lit(2)) == 1
    for part in (df.filter(~late), df.filter(late), None):
        if part is not None:
            part.write.mode("append").option("header", "true").csv(f"{base}/source")
        jobs.ingest_bronze(spark, name, f"{base}/source", f"{base}/bronze", f"{base}/state", schema=schema)
        if jobs.FEEDS[name].to_silver:
            jobs.refresh_silver(spark, name, f"{base}/bronze", f"{base}/silver", f"{base}/state")
    return base


@query
def stream_ingest_clothes(spark: SparkSession, d: str) -> DataFrame:
    """Image files that arrive in two rounds, streamed to bronze and from there to silver, then a run without new files."""
    binary_files.register(spark)
    base = fresh_path(spark, "ingest-clothes")
    feed = views.image_files(spark, d).withColumn("name", F.concat_ws("/", text.path_category("path"), text.path_file_name("path")))
    late = F.pmod(F.xxhash64("path"), F.lit(2)) == 1
    for part in (feed.filter(~late), feed.filter(late), None):
        if part is not None:
            part.select("name", "content").write.format("binary_files").mode("append").save(f"{base}/source")
        jobs.ingest_bronze(spark, "clothes", f"{base}/source/part-*/*", f"{base}/bronze", f"{base}/state")
        jobs.refresh_silver(spark, "clothes", f"{base}/bronze", f"{base}/silver", f"{base}/state")
    images_in = spark.read.parquet(f"{base}/silver")
    return images_in.select("category", "file_name", "length", "size.width", "size.height", images.is_whole_png("content").alias("whole"))


@query
def stream_ingest_sales(spark: SparkSession, d: str) -> DataFrame:
    """Sales feed as CSV files, streamed to bronze and from there to silver."""
    base = _ingested(spark, "sales", views.wide_sales(spark, d), "retail")
    return spark.read.parquet(f"{base}/silver")


@query
def stream_ingest_price(spark: SparkSession, d: str) -> DataFrame:
    base = _ingested(spark, "price", views.wide_price(spark, d), "retail")
    return rounded(spark.read.parquet(f"{base}/silver"), "price", "discount")


@query
def stream_ingest_customer(spark: SparkSession, d: str) -> DataFrame:
    base = _ingested(spark, "customer", views.customer_purchases(spark, d), "retail")
    return spark.read.parquet(f"{base}/silver")


@query
def stream_ingest_restock(spark: SparkSession, d: str) -> DataFrame:
    base = _ingested(spark, "restock", views.restock_events(spark, d), "retail")
    return spark.read.parquet(f"{base}/silver")


@query
def stream_ingest_trends(spark: SparkSession, d: str) -> DataFrame:
    """The trend feed with a declared schema of its five columns."""
    feed = views.trend_index(spark, d)
    base = _ingested(spark, "gtrends", feed, "date", feed.schema)
    return spark.read.parquet(f"{base}/silver")


@query
def stream_ingest_weather(spark: SparkSession, d: str) -> DataFrame:
    """The weather feed has no silver table; its bronze rows are the result."""
    base = _ingested(spark, "weather", views.weather(spark, d), "locality")
    return rounded(spark.read.parquet(f"{base}/bronze").drop(silver.RESCUED), *schemas.WEATHER_MEASURES)


@query
def stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The ledger kept live over three rounds of files; the last one brings the restock events of earlier weeks."""
    base = fresh_path(spark, "live-ledger")
    sales, restock = views.weekly_sales(spark, d), views.weekly_restock(spark, d)
    half = F.pmod(F.col("week"), F.lit(2)) == 0
    empty = F.lit(False)
    for sold, events in ((half, empty), (~half, half), (empty, ~half)):
        sales.filter(sold).write.mode("append").parquet(f"{base}/sales")
        restock.filter(events).write.mode("append").parquet(f"{base}/restock")
        streams = [jobs.stream_files(spark, f"{base}/{name}") for name in ("sales", "restock")]
        live.run_live_ledger(*streams, f"{base}/balances", f"{base}/state")
    return live.newest(sinks.read_merged(spark, f"{base}/balances"))


@query
def stream_fields(spark: SparkSession, d: str) -> DataFrame:
    """Restock files in two rounds. The later ones have their columns in another order and one more, and some quantities that are no
    numbers: these fields alone are rescued, by name."""
    base = fresh_path(spark, "fields")
    feed, late = views.restock_events(spark, d), F.col("retail").cast("int") % 2 == 1
    wrong = F.when(F.col("retail").cast("int") % 4 == 1, F.concat("qty", F.lit("x"))).otherwise(F.col("qty"))
    other = feed.filter(late).select(wrong.alias("qty"), F.concat(F.lit("s"), "retail").alias("source"), "year", "week", "retail", "external_code")
    schema = T.StructType.fromDDL("external_code string, retail int, week int, year int, qty int")
    for part in (feed.filter(~late), other):
        part.write.mode("append").option("header", "true").csv(f"{base}/source")
        jobs.ingest_fields(spark, f"{base}/source", f"{base}/bronze", f"{base}/state", schema)
    rows = sinks.read_merged(spark, f"{base}/bronze")
    fits = F.col(fields.RESCUED_FIELDS).isNull().alias("fits")
    rescued = F.explode_outer(fields.RESCUED_FIELDS).alias("field", "value")
    return rows.select(*schema.names, "source", fits, F.col(fields.FILE).endswith(".csv").alias("has_file"), rescued)


@query
def stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Restock lines whose quantity is no number, found again whole in the quarantine table."""
    odd = F.col("retail").cast("int") % 2 == 1
    feed = views.restock_events(spark, d).withColumn("qty", F.when(odd, F.concat("qty", F.lit("x"))).otherwise(F.col("qty")))
    base = fresh_path(spark, "quarantine")
    feed.write.option("header", "true").csv(f"{base}/source")
    typed = T.StructType([*schemas.RESTOCK.fields[:-1], T.StructField("qty", T.LongType())])
    jobs.ingest_bronze(spark, "restock", f"{base}/source", f"{base}/bronze", f"{base}/state", schema=typed)
    jobs.quarantine(spark, "restock", f"{base}/bronze", f"{base}/rescued", f"{base}/state")
    return spark.read.parquet(f"{base}/rescued").select(F.col(silver.RESCUED).alias("line"))


@query
def stream_new_column(spark: SparkSession, d: str) -> DataFrame:
    """Restock files that gain a column in their second round; the first round's rows have none."""
    base = fresh_path(spark, "growing")
    feed = views.restock_events(spark, d)
    odd = F.col("retail").cast("int") % 2 == 1
    for part in (feed.filter(~odd), feed.filter(odd).select(F.concat(F.lit("s"), "retail").alias("source"), "*")):
        part.write.mode("append").option("header", "true").csv(f"{base}/source")
        jobs.ingest_growing(spark, f"{base}/source", f"{base}/bronze", f"{base}/state")
    rows = sinks.read_merged(spark, f"{base}/bronze").drop(sinks.BATCH_COLUMN)
    return silver.silver_restock(rows)


@query
def stream_table(spark: SparkSession, d: str) -> DataFrame:
    """Restock events streamed from one catalog table to the next, twice."""
    base, tag = fresh_path(spark, "tables"), uuid.uuid4().hex
    bronze, target = f"bronze_restock_{tag}", f"silver_restock_{tag}"
    views.restock_events(spark, d).write.parquet(f"{base}/source")
    for _ in range(2):
        sinks.append_table(jobs.stream_files(spark, f"{base}/source"), bronze, f"{base}/bronze")
        jobs.refresh_silver_table(spark, "restock", bronze, target, f"{base}/state")
    return spark.table(target)


@query
def table_refresh(spark: SparkSession, d: str) -> DataFrame:
    """A table saved, and saved again with another schema."""
    name = f"trends_{uuid.uuid4().hex}"
    feed = views.trend_index(spark, d)
    gold.save_table(feed.select("date"), name)
    gold.save_table(silver.silver_trends(feed), name)
    return spark.table(name)


@query
def stream_micro_batches(spark: SparkSession, d: str) -> DataFrame:
    """The restock feed through a per-batch callback, each batch written twice."""
    base = fresh_path(spark, "batches")
    views.restock_events(spark, d).write.parquet(f"{base}/source")

    def write(batch: DataFrame, batch_id: int) -> None:
        typed = silver.silver_restock(batch)
        sinks.write_batch(typed, batch_id, f"{base}/silver")
        sinks.write_batch(typed, batch_id, f"{base}/silver")

    sinks.each_batch(jobs.stream_files(spark, f"{base}/source"), write, f"{base}/state")
    return spark.read.parquet(f"{base}/silver").drop(sinks.BATCH_COLUMN)
