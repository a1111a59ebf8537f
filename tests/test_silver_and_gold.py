import datetime as dt

import pytest
from pyspark.sql import functions as F

from hemline.operators import joins, reshape, silver
from hemline.plans import gold
from hemline.sources import schemas, views
from tests.test_calendar_and_text import png

WEEKS = [str(w) for w in range(12)]


def sales_row(code="5198", retail="100", release="2019-5-6", restock="12", sales=None):
    values = sales or ["2.0", "1.0", *["0.0"] * 10]
    return (code, retail, "SS19", "culottes", "grey", f"SS19/{code}.png", "linen", release, restock, *values)


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [
            sales_row(),
            sales_row("1425", "10", "2018-12-10", "6", ["1.0", None, "-1.0", "3.7", "x", *["0.0"] * 7]),
            sales_row("7", "1", "bad", "", ["1.0"] * 12),
        ],
        schemas.SALES,
    )


def test_unpivot_keeps_all_weeks_and_the_sum(spark, wide):
    long = reshape.unpivot_weeks(wide, ["external_code"], "sales")
    assert long.count() == wide.count() * 12
    total = long.agg(F.sum(F.expr("try_cast(sales AS double)"))).first()[0]
    assert total == pytest.approx(3.0 + 3.7 + 12.0)


def test_silver_sales_types_and_calendar(wide):
    out = silver.silver_sales(wide)
    row = out.filter("external_code = '1425' AND week = 3").first()
    assert (row.sales, row.restock, row.release_week_of_year) == (3, 6, 50)
    assert (row.current_week_of_year, row.current_date_of_week) == (53, dt.date(2018, 12, 31))
    assert (row.release_year, row.release_month, row.release_day, row.season_category) == (2018, 12, 10, "SS")
    by_week = {r.week: r.sales for r in out.filter("external_code = '1425'").collect()}
    assert [by_week[w] for w in range(5)] == [1, None, -1, 3, None]


def test_silver_sales_bad_release_date(wide):
    row = silver.silver_sales(wide).filter("external_code = '7' AND week = 0").first()
    assert (row.release_date, row.current_date_of_week, row.restock, row.release_day) == (None,) * 4
    assert row.sales == 1


def test_silver_drops_rescued_column(wide):
    out = silver.silver_sales(wide.withColumn(silver.RESCUED, F.lit("x")))
    assert silver.RESCUED not in out.columns


def test_silver_price(spark, rows):
    frame = spark.createDataFrame([("1", "2", "9.5", *["0.1"] * 11, None)], schemas.PRICE)
    out = silver.silver_price(frame)
    assert out.count() == 12
    assert dict(out.dtypes)["discount"] == "float"
    assert out.filter("week = 11").first().discount is None


def test_silver_customer(spark):
    frame = spark.createDataFrame([("2017-01-01 10:00:00", "3", "2"), (None, "3", "x")], schemas.CUSTOMER)
    out = {r.retail if r.date is None else r.date: r for r in silver.silver_customer(frame).collect()}
    first = out[dt.date(2017, 1, 1)]
    assert (first.year, first.month, first.weekofyear, first.qty) == (2017, 1, 52, 2)
    assert "data" not in first.asDict()
    assert out[3].qty is None


def test_silver_images(spark):
    frame = spark.createDataFrame([("/x/AW17/dress/1.png", png(3, 4))], "path string, content binary")
    row = silver.silver_images(frame).first()
    assert (row.category, row.file_name, row.size.width, row.size.height) == ("dress", "1.png", 3, 4)


def test_embedding_reshape(spark, rows):
    frame = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0])], "k string, embed array<float>")
    assert rows(reshape.explode_embedding(frame, ["k"])) == [("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)]
    assert rows(reshape.embedding_columns(frame, ["k"], 2)) == [("a", 1.0, 2.0), ("b", 3.0, None)]


def stats_frame(spark):
    days = ["2016-12-31", "2017-01-01", "2017-01-02"]
    frame = spark.createDataFrame([(f"{d} 08:00:00", "1", "2") for d in days], schemas.CUSTOMER)
    return silver.silver_customer(frame)


def test_customer_stats_calendars(spark, rows):
    columns = ["retail_total_sales_qty", "retail_total_customer_purchase"]
    parity = joins.customer_week_stats(stats_frame(spark))
    assert rows(parity, "current_year", "current_week_of_year", *columns) == [
        (2016, 52, 2, 1),
        (2017, 1, 2, 1),
        (2017, 52, 2, 1),
    ]
    iso = joins.customer_week_stats(stats_frame(spark), "iso")
    assert rows(iso, "week_start", *columns) == [
        (dt.date(2016, 12, 26), 4, 2),
        (dt.date(2017, 1, 2), 2, 1),
    ]


def test_gold_features_keeps_rows_and_matches(spark, wide):
    sales = silver.silver_sales(wide)
    price = silver.silver_price(
        spark.createDataFrame([("5198", "100", "30.0", *["0.2"] * 12)], schemas.PRICE)
    )
    customer = silver.silver_customer(
        spark.createDataFrame([("2019-05-07 09:00:00", "100", "4")], schemas.CUSTOMER)
    )
    trends = silver.silver_trends(
        spark.createDataFrame([(dt.date(2019, 5, 6), 1.0), (dt.date(2019, 5, 13), 2.0)], "date date, linen float")
    )
    out = gold.gold_features(sales, price, customer, trends)
    assert out.count() == sales.count()
    row = out.filter("external_code = '5198' AND week = 0").first()
    assert (row.price, row.retail_total_sales_qty, row.linen) == (30.0, 4, 1.0)
    assert row.unique_id == "5198100SS19culottesgreylinen2019-05-06"
    assert out.filter("external_code = '5198' AND week = 5").first().linen is None
    iso = gold.gold_features(sales, price, customer, trends, "iso")
    assert iso.count() == sales.count()


def test_trend_join_across_a_month_end(spark):
    """A sales date in another month than its week's Monday matches by week start only."""
    trends = silver.silver_trends(spark.createDataFrame([(dt.date(2019, 4, 29), 7.0)], "date date, linen float"))
    day = spark.createDataFrame([(dt.date(2019, 5, 2),)], "ds date").withColumns(
        {
            "current_week_of_year": F.weekofyear("ds"),
            "current_month": F.month("ds"),
            "current_year": F.year("ds"),
            "week_start": F.date_trunc("week", "ds").cast("date"),
        }
    )
    assert joins.with_trends(day, trends).first().linen is None
    assert joins.with_trends(day, trends, "iso").first().linen == 7.0


def test_gold_image_features_with_hook(spark):
    frame = spark.createDataFrame(
        [("/x/a/1.png", png(2, 2)), ("/x/a/2.png", b"no"), ("/x/a/3.png", None)],
        "path string, content binary",
    )

    def factory():
        return lambda contents: [[float(len(c))] for c in contents]

    out = gold.gold_image_features(silver.silver_images(frame), factory).collect()
    assert [(r.img_path, r.embed) for r in out] == [("a/1.png", [24.0])]


def test_save_table_replaces_the_schema(spark):
    gold.save_table(spark.range(3), "t_replace")
    gold.save_table(spark.range(2).withColumn("x", F.lit(1)), "t_replace")
    assert spark.table("t_replace").columns == ["id", "x"]
    assert spark.table("t_replace").count() == 2


def test_semi_join_does_not_multiply(spark):
    ids = spark.createDataFrame([("a",), ("a",)], "unique_id string")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "unique_id string, y int")
    assert joins.keep_series(rows, ids).count() == 1


def test_no_python_in_the_table_builders(spark):
    from hemline.plans import queries

    folder = "/root/testdata/sf0.001"
    names = ["silver_sales", "silver_price", "silver_customer", "silver_restock", "silver_trends", "silver_images"]
    names += ["gold_features", "gold_restock", "gold_inventory", "series_semi_join"]
    for name in names:
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas")), name


def test_feature_table_exchanges(spark):
    from hemline.plans import queries

    plan = queries.features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4, plan


def test_every_sale_is_in_a_week(spark):
    from hemline.sources import views

    folder = "/root/testdata/sf0.001"
    wide = views.releases(spark, folder)
    total = wide.selectExpr("sum(qty) AS a", f"sum({' + '.join(f'w{i}' for i in range(12))}) AS b").first()
    sold = views.lines(spark, folder, inflow=False).selectExpr("sum(qty)").first()[0]
    assert total.a == total.b == sold


def test_feeds_joined_before_the_reshape_equal_the_joined_silver_tables(spark, wide):
    prices = [("5198", "100", "9.5", *["0.1"] * 11, None), ("1425", "10", "x", *[str(i / 10) for i in range(12)]), ("9", "1", "1", *["0"] * 12)]
    names = ["external_code", "retail", "price", *[str(i) for i in range(12)]]
    price = spark.createDataFrame(prices, ", ".join(f"`{n}` string" for n in names))
    want = joins.with_price(silver.silver_sales(wide), silver.silver_price(price))
    got = silver.silver_priced_sales(wide, price)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count() > 0
    assert got.filter("discount IS NOT NULL").count() > 0
    plan = silver.silver_priced_sales(wide.repartition(3), price.repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1


@pytest.fixture
def store_feeds(spark, wide):
    """Wide feeds and customers; two prices of one item and store, an unknown store, a row without a date and one without a store."""
    names = ["external_code", "retail", "price", *WEEKS]
    prices = [("5198", "100", "9.5", *["0.1"] * 11, None), ("5198", "100", "9", *["0.3"] * 12), ("1425", "10", "x", *["0.2"] * 12)]
    price = spark.createDataFrame(prices, ", ".join(f"`{n}` string" for n in names))
    bought = [("2019-05-07 09:00:00", "100", "4"), ("2019-05-20 09:00:00", "100", None), ("2018-12-31 09:00:00", "10", "2")]
    bought += [("2018-12-10 09:00:00", "10", "7"), (None, "10", "3"), ("2018-12-10 09:00:00", None, "1")]
    customer = silver.silver_customer(spark.createDataFrame(bought, schemas.CUSTOMER))
    return wide.union(spark.createDataFrame([sales_row("8", None)], schemas.SALES)), price, customer


@pytest.mark.parametrize("calendar", ["parity", "iso"])
def test_store_statistics_joined_before_the_reshape_equal_those_joined_after(store_feeds, calendar):
    sales, price, customer = store_feeds
    stats = joins.customer_week_stats(customer, calendar)
    rows = gold.sales_rows(silver.silver_priced_sales(sales, price), "price", "discount")
    if calendar == "iso":
        rows = rows.withColumn("week_start", F.date_trunc("week", "ds").cast("date"))
    want = joins.with_customer_stats(rows, stats, calendar)
    got = gold.store_rows(sales, price, joins.stats_by_store(stats, calendar), calendar)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 60
    assert got.filter("retail_total_sales_qty IS NOT NULL").count() >= 3


def test_rows_of_a_week_are_not_exchanged_for_statistics_or_lags(spark, store_feeds):
    from hemline.operators import forecast

    sales, price, customer = store_feeds
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        by_store = joins.stats_by_store(joins.customer_week_stats(customer))
        rows = gold.store_rows(sales.repartition(3), price.repartition(3), by_store.repartition(3))
        frame = forecast.model_frame(rows, [], steps="unique")
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" in plan and "Exchange" not in plan.split("Generate inline")[0], plan


def test_id_lists_meet_the_wide_rows(spark):
    from hemline.plans import queries

    plan = queries.QUERIES["id_list_split"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    sides = plan.split("Expand")
    assert len(sides) == 3 and "LeftSemi" not in sides[0]
    assert all(s.count("LeftSemi") == 1 for s in sides[1:]), plan


def test_releases_are_not_exchanged_by_brand(spark, tmp_path):
    """The brands of a large part table are few: they are sent to the releases, which stay where they are."""
    part = spark.range(5000).selectExpr(
        "id AS p_partkey", "concat('Brand#', 11 + id % 3) AS p_brand", "md5(cast(id AS string)) AS p_type", "concat(md5(cast(id AS string)), ' b c') AS p_name"
    )
    lines = spark.range(40).selectExpr(
        "id AS l_partkey", "id % 4 AS l_suppkey", "'N' AS l_returnflag", "timestamp '1998-01-05' AS l_shipdate",
        "1.0D AS l_quantity", "2.0D AS l_extendedprice", "0.1D AS l_discount",
    )
    part.write.parquet(f"{tmp_path}/part.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)
    try:
        released = views.releases(spark, str(tmp_path))
        released.write.parquet(f"{tmp_path}/released")
        wide = views.wide_sales(spark, str(tmp_path), spark.read.parquet(f"{tmp_path}/released"))
        assert "hashpartitioning(brand" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.select("fabric").distinct().collect()[0][0] == "b" and wide.count() == released.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
