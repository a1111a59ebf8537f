"""Calendar and number parsing that gives NULL on bad text, with ANSI mode left on.

Three week systems meet in the feeds and are kept apart by name: the ISO week (``weekofyear``), the
week counted on from a release without wrapping at year end, and the US week (starts on Sunday, week 1
holds 1 January) in which restock dates are written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the feeds.
PURCHASE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RELEASE_DATE_FORMAT = "yyyy-M-d"

# Fixed value: a number text whose part before the point is the integer.
WHOLE_PART = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(c: Column | str, kind: str) -> Column:
    """The pattern is tried only where the plain cast fails."""
    digits = F.regexp_extract(_col(c).cast("string"), WHOLE_PART, 1)
    return F.coalesce(_col(c).try_cast(kind), digits.try_cast(kind))


def text_to_int(c: Column | str) -> Column:
    """``'12'`` and ``'12.0'`` -> 12; NULL for other text or when out of range."""
    return _whole(c, "int")


def text_to_quantity(c: Column | str) -> Column:
    """As :func:`text_to_int`, as a bigint: sums of quantities outgrow an int."""
    return _whole(c, "bigint")


def text_to_float(c: Column | str) -> Column:
    return _col(c).try_cast("float")


def decimal_text_to_quantity(c: Column | str) -> Column:
    """``'3.7'`` -> 3, ``'-3.7'`` -> -3: cut towards zero, exact for every digit; a bigint."""
    whole = F.regexp_extract(_col(c).cast("string"), WHOLE_PART, 1).try_cast("bigint")
    return F.coalesce(whole, _col(c).try_cast("decimal(38,10)").try_cast("bigint"))


def purchase_date(c: Column | str) -> Column:
    return F.try_to_date(_col(c), PURCHASE_TIME_FORMAT)


def release_date(c: Column | str) -> Column:
    return F.try_to_date(_col(c), RELEASE_DATE_FORMAT)


def date_text_part(c: Column | str, position: int) -> Column:
    """One dash-separated part of a date text as integer; NULL when absent or not a number."""
    return F.get(F.split(_col(c), "-"), F.lit(position)).try_cast("int")


def padded_week(week: Column | str) -> Column:
    return F.lpad(_col(week).cast("string"), 2, "0")


def week_start(day: Column | str) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", _col(day)).cast("date")


def iso_year(day: Column | str) -> Column:
    """Year of the Thursday of the ISO week: the year that belongs to ``weekofyear``."""
    return F.year(F.date_add(week_start(day), 3))


def _first_of(year: Column, month: int, day: int) -> Column:
    in_range = year.between(1, 9998)
    return F.make_date(F.when(in_range, year), F.lit(month), F.lit(day))


def us_week_tuesday(year: Column | str, week: Column | str) -> Column:
    """Tuesday of a US week; NULL where the week runs into a neighbouring year.

    Same values as parsing ``year || week || '2'`` with the pattern ``yyyywwu`` in legacy mode, without
    needing that mode.
    """
    year, week = _col(year), _col(week)
    jan1 = _first_of(year, 1, 1)
    sunday_based = F.dayofweek(jan1) - 1
    tuesday = F.date_add(jan1, F.lit(2) - sunday_based + (week - 1) * 7)
    valid = (
        week.between(1, 53) & (F.year(tuesday) == year) & (F.year(F.date_add(tuesday, 4)) == year)
    )
    return F.when(valid, tuesday)


def iso_week_monday(year: Column | str, week: Column | str) -> Column:
    """Monday of ISO week ``week`` of ISO year ``year``; weeks past the year end run on."""
    jan4 = _first_of(_col(year), 1, 4)
    return F.date_add(week_start(jan4), (_col(week) - 1) * 7)
