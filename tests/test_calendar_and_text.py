import datetime as dt

import pytest
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.functions import images, text


def one(spark, value, column, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, expected",
    [("12", 12), ("3.0", 3), ("3.7", 3), ("-3.7", -3), ("", None), ("x", None), (None, None), ("99999999999", None)],
)
def test_text_to_int(spark, value, expected):
    assert one(spark, value, cal.text_to_int("v")) == expected


@pytest.mark.parametrize(
    "value, expected", [("2.0", 2), ("3.7", 3), ("-3.7", -3), ("", None), ("n/a", None), (None, None)]
)
def test_decimal_text_to_int(spark, value, expected):
    assert one(spark, value, cal.decimal_text_to_quantity("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2019-5-6", dt.date(2019, 5, 6)),
        ("2019-05-06", dt.date(2019, 5, 6)),
        ("2019/05/06", None),
        (None, None),
    ],
)
def test_release_date(spark, value, expected):
    assert one(spark, value, cal.release_date("v")) == expected


def test_date_text_part_out_of_range(spark):
    assert one(spark, "2019-5", cal.date_text_part("v", 2)) is None
    assert one(spark, "2019-5-6", cal.date_text_part("v", 2)) == 6


def test_purchase_date(spark):
    assert one(spark, "2017-03-04 10:11:12", cal.purchase_date("v")) == dt.date(2017, 3, 4)
    assert one(spark, "2017-03-04T10", cal.purchase_date("v")) is None


@pytest.mark.parametrize(
    "day, week, iso_year",
    [
        ("2016-12-31", 52, 2016),
        ("2017-01-01", 52, 2016),
        ("2018-12-31", 1, 2019),
        ("2019-01-01", 1, 2019),
    ],
)
def test_iso_week_around_new_year(spark, day, week, iso_year):
    frame = spark.createDataFrame([(dt.date.fromisoformat(day),)], "v date")
    assert tuple(frame.select(F.weekofyear("v"), cal.iso_year("v")).first()) == (week, iso_year)


def us_week_tuesday(year, week):
    """By walking the days of the year."""
    days = [dt.date(year, 1, 1) + dt.timedelta(n) for n in range(366)]
    days = [d for d in days if d.year == year]
    first_sunday = days[0] - dt.timedelta((days[0].weekday() + 1) % 7)
    start = first_sunday + dt.timedelta(7 * (week - 1))
    tuesday, saturday = start + dt.timedelta(2), start + dt.timedelta(6)
    return tuesday if tuesday.year == year and saturday.year == year else None


def test_us_week_tuesday_against_day_walk(spark):
    pairs = [(y, w) for y in range(1994, 2027) for w in range(1, 54)]
    frame = spark.createDataFrame(pairs, "y int, w int")
    got = {(r.y, r.w): r.t for r in frame.select("y", "w", cal.us_week_tuesday("y", "w").alias("t")).collect()}
    assert got == {(y, w): us_week_tuesday(y, w) for y, w in pairs}


def test_us_week_tuesday_fixed_cases(spark):
    frame = spark.createDataFrame([(2019, 30), (2014, 1), (2014, 53), (2019, 0), (None, 3)], "y int, w int")
    got = [r[0] for r in frame.select(cal.us_week_tuesday("y", "w")).collect()]
    assert got == [dt.date(2019, 7, 23), None, None, None, None]


def test_iso_week_monday_is_inverse_of_week(spark):
    days = [(dt.date(1995, 1, 2) + dt.timedelta(7 * n),) for n in range(1200)]
    frame = spark.createDataFrame(days, "d date")
    wrong = frame.filter(cal.iso_week_monday(cal.iso_year("d"), F.weekofyear("d")) != F.col("d"))
    assert wrong.count() == 0


def test_series_id_is_null_with_a_null_part_and_can_collide(spark):
    schema = "external_code string, retail int, season string, category string, color string, fabric string, release_date date"
    day = dt.date(2017, 10, 16)
    frame = spark.createDataFrame(
        [
            ("1425", 10, "AW17", "short coat", "brown", "fur", day),
            ("142", 510, "AW17", "short coat", "brown", "fur", day),
            ("1425", 10, None, "short coat", "brown", "fur", day),
        ],
        schema,
    )
    ids = [r[0] for r in frame.select(text.series_id()).collect()]
    assert ids == ["142510AW17short coatbrownfur2017-10-16"] * 2 + [None]


def test_path_parts(spark):
    frame = spark.createDataFrame([("s3://b/AW17/dress/0001.png",), ("plain",)], "p string")
    got = [tuple(r) for r in frame.select(text.path_category("p"), text.path_file_name("p")).collect()]
    assert got == [("dress", "0001.png"), ("", None)]


def png(width, height):
    head = bytes.fromhex("89504E470D0A1A0A0000000D49484452")
    return head + width.to_bytes(4, "big") + height.to_bytes(4, "big")


def test_png_header(spark):
    good = png(500, 600)
    frame = spark.createDataFrame(
        [(good,), (b"\x00" + good[1:],), (good[:20],), (None,)], "c binary"
    )
    got = [
        (r.ok, r.s.width, r.s.height)
        for r in frame.select(images.is_png("c").alias("ok"), images.png_size("c").alias("s")).collect()
    ]
    assert got == [(True, 500, 600), (False, None, None), (False, None, None), (False, None, None)]


@pytest.mark.parametrize(
    "value,expected",
    [("16777217.0", 16777217), ("123456789.0", 123456789), ("3000000000", 3000000000), ("-3.7", -3), ("1.5E3", 1500), ("x", None)],
)
def test_quantities_keep_every_digit(spark, value, expected):
    assert one(spark, value, cal.decimal_text_to_quantity("v")) == expected


def test_plain_quantities_outgrow_an_int(spark):
    assert one(spark, "3000000000", cal.text_to_quantity("v")) == 3000000000
    assert one(spark, "3000000000", cal.text_to_int("v")) is None
