import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hemline.functions import calendar as cal
from hemline.operators import inventory

SALES = "external_code string, retail int, week int, year int, date date, sales int, restock int"
RESTOCK = "external_code string, retail int, week int, year int, qty int"


def weeks(code, start, values, restock=10, first_week=None):
    day = dt.date.fromisoformat(start)
    week = first_week or day.isocalendar().week
    out = []
    for i, v in enumerate(values):
        d = day + dt.timedelta(7 * i)
        out.append((code, 1, week + i, d.year, d, v, restock))
    return out


def brute_force(sales, restock):
    """All pairs, first match per date, running sum by week with peers."""
    opening = {}
    for r in sorted(sales, key=lambda r: (r[4] is None, r[4], r[2])):
        opening.setdefault(r[:2], (r[0], r[1], r[2], r[3], r[6]))
    inflow = [*opening.values(), *restock]
    best = {}
    for s in sales:
        matches = [i[4] or 0 for i in inflow if i[:4] == s[:4]] or [0]
        for q in matches:
            key, rank = (s[0], s[1], s[4]), (q, s[2], s[5])
            if key not in best or rank < best[key]:
                best[key] = rank
    out = {}
    for (code, retail, day), (q, week, sold) in best.items():
        peers = [v for k, v in best.items() if k[:2] == (code, retail) and v[1] <= week]
        out[(code, retail, day)] = (week, sold, q, sum(p[0] - p[2] for p in peers))
    return out


def ledger_dict(df):
    return {
        (r.external_code, r.retail, r.date): (r.week, r.sales, r.qty, r.accumulated_inventory)
        for r in df.collect()
    }


def test_ledger_small_case(spark):
    sales = weeks("a", "2019-03-04", [2, 3, 1])
    restock = [("a", 1, 11, 2019, 5)]
    out = ledger_dict(
        inventory.stock_ledger(spark.createDataFrame(sales, SALES), spark.createDataFrame(restock, RESTOCK))
    )
    assert [out[k][2:] for k in sorted(out)] == [(10, 8), (5, 10), (0, 9)]


def test_ledger_against_brute_force(spark):
    rng = random.Random(5)
    sales, restock = [], []
    for code in "abcde":
        start = f"{rng.choice([2018, 2019])}-{rng.choice(['03-04', '11-26', '12-17'])}"
        sales += weeks(code, start, [rng.randint(0, 5) for _ in range(8)])
        restock += [(code, 1, rng.randint(9, 20), rng.choice([2018, 2019]), rng.randint(0, 9)) for _ in range(6)]
        restock += [(code, 1, rng.randint(48, 53), 2018, rng.randint(0, 9)) for _ in range(4)]
    sales += [(*r[:5], r[5] + 1, r[6]) for r in rng.sample(sales, 10)]
    out = inventory.stock_ledger(spark.createDataFrame(sales, SALES), spark.createDataFrame(restock, RESTOCK))
    assert ledger_dict(out) == brute_force(sales, restock)


def test_hot_key_copies_do_not_fan_out(spark):
    one = weeks("hot", "2019-03-04", [2, 3])
    sales = spark.createDataFrame(one, SALES).crossJoin(spark.range(3000)).drop("id")
    restock = spark.createDataFrame([("hot", 1, 11, 2019, 4)], RESTOCK).crossJoin(spark.range(3000)).drop("id")
    out = ledger_dict(inventory.stock_ledger(sales, restock))
    assert [out[k][2:] for k in sorted(out)] == [(10, 8), (4, 9)]


def test_null_keys_match_nothing(spark):
    sales = [("a", 1, None, None, None, 1, 7), ("a", 1, 10, 2019, dt.date(2019, 3, 4), 1, 7)]
    restock = [("a", 1, None, None, 50)]
    out = inventory.first_match(spark.createDataFrame(sales, SALES), spark.createDataFrame(restock, RESTOCK))
    assert {(r.week, r.qty) for r in out.collect()} == {(None, 0), (10, 7)}


def test_iso_finds_restock_after_new_year(spark):
    sales = spark.createDataFrame(weeks("a", "2018-12-17", [1, 1, 1, 1]), SALES)
    restock = spark.createDataFrame([("a", 1, 2, 2019, 6)], RESTOCK)
    parity = ledger_dict(inventory.stock_ledger(sales, restock))
    iso = ledger_dict(inventory.stock_ledger(sales, restock, "iso"))
    day = dt.date(2019, 1, 7)
    assert parity[("a", 1, day)][2] == 0
    assert iso[("a", 1, day)][2:] == (6, 12)


def test_unknown_calendar(spark):
    empty = spark.createDataFrame([], SALES)
    with pytest.raises(ValueError):
        inventory.first_match(empty, spark.createDataFrame([], RESTOCK), "lunar")


def test_running_balance_shares_peers(spark):
    frame = spark.createDataFrame([("a", 1, 1, 5), ("a", 1, 1, 7), ("a", 1, 2, 1)], "external_code string, retail int, week int, q int")
    out = inventory.running_balance(frame, F.col("q"), "week", "s")
    assert sorted((r.week, r.s) for r in out.collect()) == [(1, 12), (1, 12), (2, 13)]


def test_closing_balance_is_inflow_minus_sales(spark):
    sales = spark.createDataFrame(weeks("a", "2019-03-04", [4, 4, 4, 4]), SALES)
    out = inventory.stock_ledger(sales, spark.createDataFrame([("a", 1, 12, 2019, 9)], RESTOCK))
    last = max(out.collect(), key=lambda r: r.date)
    assert last.accumulated_inventory == 10 + 9 - 16


def test_restock_log_dates(spark):
    sales = spark.createDataFrame(weeks("a", "2019-03-04", [1]), SALES)
    out = inventory.restock_log(sales, spark.createDataFrame([("a", 1, 30, 2019, 3)], RESTOCK))
    assert {(r.week, r.date, r.qty, r.year) for r in out.collect()} == {
        (10, dt.date(2019, 3, 4), 10, 2019),
        (30, dt.date(2019, 7, 23), 3, 2019),
    }


def test_reorder_plan(spark):
    ledger = spark.createDataFrame([("a", 1, dt.date(2019, 3, 4), 5)], "external_code string, retail int, date date, accumulated_inventory int")
    plan = spark.createDataFrame([("a", 1, dt.date(2019, 3, 4), 7.0, 9.0)], "external_code string, retail int, ds date, forecast double, hi_ci double")
    row = inventory.reorder_plan(ledger, plan).first()
    assert (row.projected_inventory, row.stock_out, row.order_qty) == (-2.0, True, 4.0)


def test_ledger_plan_has_two_exchanges_and_no_python(spark):
    """One for the map-side aggregate, one for all windows."""
    sales = spark.createDataFrame(weeks("a", "2019-03-04", [1]), SALES)
    out = inventory.stock_ledger(sales, spark.createDataFrame([("a", 1, 30, 2019, 3)], RESTOCK))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "Python" not in plan


def test_week_start_of_iso_monday(spark):
    row = spark.range(1).select(cal.iso_week_monday(F.lit(2019), F.lit(1)).alias("d")).first()
    assert row.d == dt.date(2018, 12, 31)


def test_no_order_without_a_forecast(spark):
    ledger = spark.createDataFrame([("1", 2, dt.date(2019, 1, 7), -5)], "external_code string, retail int, date date, accumulated_inventory long")
    known = "external_code string, retail int, ds date, forecast double, hi_ci double"
    row = inventory.reorder_plan(ledger, spark.createDataFrame([], known)).first()
    assert (row.projected_inventory, row.stock_out, row.order_qty) == (None, None, None)
