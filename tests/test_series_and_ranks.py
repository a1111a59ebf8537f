import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from hemline.operators import conformal, encoding, metrics, order_stats, runs, series

PANEL = "unique_id string, ds date, y int, x double"


def day(n):
    return dt.date(2019, 1, 7) + dt.timedelta(7 * n)


@pytest.fixture
def panel(spark):
    rows = [("a", day(n), n, float(n)) for n in range(4)]
    rows += [("b", day(0), 5, float("nan")), ("b", day(3), -2, 1.0), ("c", day(0), None, None)]
    return spark.createDataFrame(rows, PANEL)


@pytest.mark.parametrize("steps", ["unique", "max"])
def test_exog_lags_are_positional_and_filled(panel, steps):
    out = series.exog_lags(panel, ["x"], key="unique_id", steps=steps)
    got = {(r.unique_id, r.ds): (r.x_lag1, r.x_lag2) for r in out.collect()}
    assert got[("a", day(3))] == (2.0, 1.0)
    assert got[("a", day(0))] == (-1.0, -1.0)
    assert got[("b", day(3))] == (-1.0, -1.0)  # the value before is NaN
    assert got[("c", day(0))] == (-1.0, -1.0)
    assert len(got) == 7


def test_repeated_steps_keep_all_copies(panel):
    tripled = panel.unionByName(panel).unionByName(panel)
    out = series.target_lag(series.clip_target(tripled), key="unique_id", steps="max")
    got = sorted((r.unique_id, r.ds, r.lag1) for r in out.collect())
    assert got == sorted(3 * [("a", day(1), 0), ("a", day(2), 1), ("a", day(3), 2), ("b", day(3), 5)])


def test_target_lag_flag(panel):
    assert "lag1" not in series.target_lag(panel, key="unique_id", keep_lag=False, steps="unique").columns


@pytest.mark.parametrize("steps", ["unique", "max"])
def test_horizon_and_lag_are_inverse(panel, steps):
    ahead = series.horizon_target(panel.filter("unique_id = 'a'"), horizon=2, key="unique_id", steps=steps)
    back = series.shifted(
        ahead, series.target_lag_columns("y1", key="unique_id"), ["y1"], "unique_id", steps=steps
    ).filter("lag1 IS NOT NULL")
    assert back.filter("lag1 <> y").count() == 0 and back.count() == 3


def test_clip_target(panel):
    got = {(r.unique_id, r.ds): r.y for r in series.clip_target(panel).collect()}
    assert got[("b", day(3))] == 0 and got[("c", day(0))] is None


def test_steps_from_end(panel):
    out = series.steps_from_end(panel.unionByName(panel), key="unique_id", steps="max")
    assert {r.back for r in out.filter("unique_id = 'a'").collect()} == {1, 2, 3, 4}


def test_bad_steps(panel):
    with pytest.raises(ValueError):
        series.exog_lags(panel, ["x"], key="unique_id", steps="some")


def test_unique_lags_use_one_exchange(panel):
    plan = series.exog_lags(panel, ["x", "y"], key="unique_id", steps="unique")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


def skewed_values(spark, n=2000):
    rng = random.Random(3)
    rows = [("hot", rng.choice([0.0, 1.0, rng.gauss(5, 2)])) for _ in range(n)]
    rows += [(f"g{i}", rng.uniform(-5, 5)) for i in range(5) for _ in range(17 + i)]
    return rows, spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("parts", [1, 5, 40, None])
def test_running_counts_do_not_depend_on_ranges(spark, parts):
    rows, frame = skewed_values(spark)
    counted = frame.groupBy("g", "v").agg(F.count("*").alias("n"))
    out = order_stats.running_counts(counted, ["g"], "v", ["n"], parts).collect()
    for g in {r[0] for r in rows}:
        values = sorted(v for k, v in rows if k == g)
        distinct = sorted(set(values))
        mine = sorted((r for r in out if r.g == g), key=lambda r: r.v)
        assert [r.v for r in mine] == distinct
        assert [r.cum_n for r in mine] == [sum(x <= v for x in values) for v in distinct]
        assert {r.total_n for r in mine} == {len(values)}
        assert [r.next_value for r in mine] == [*distinct[1:], None]


@pytest.mark.parametrize("parts", [9, None])
def test_order_statistics_per_group(spark, parts):
    rows, frame = skewed_values(spark)
    out = order_stats.order_statistics(
        frame, ["g"], "v", {"third": lambda n: F.lit(3), "beyond": lambda n: n + 1}, parts
    )
    got = {r.g: (r.n, r.third, r.beyond) for r in out.collect()}
    for g in {r[0] for r in rows}:
        values = sorted(v for k, v in rows if k == g)
        assert got[g] == (len(values), values[2], None)


def test_values_with_a_common_prefix_are_spread(spark):
    frame = spark.range(10_000).select(F.format_string("Customer#%09d", "id").alias("c"))
    dealt = order_stats.ranged(frame, ["c"], 8)
    sizes = [r["count"] for r in dealt.groupBy(order_stats.PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000
    codes = encoding.category_codes(frame, ["c"], 8).orderBy("value").collect()
    assert [r.code for r in codes] == list(range(10_000))


def test_null_parts_of_a_series_key_keep_series_apart(spark):
    rows = [(None, s, 2019, 1, 7, day(n), 10 * s + n) for s in (1, 2) for n in range(2)]
    frame = spark.createDataFrame(
        rows, "external_code string, retail int, release_year int, release_month int, release_day int, ds date, y int"
    )
    for steps in ("unique", "sum"):
        got = {(r.retail, r.ds): r.lag1 for r in series.target_lag(frame, steps=steps).collect()}
        assert got == {(1, day(1)): 10, (2, day(1)): 20}


def test_reduction_of_repeated_steps_is_the_one_named(spark):
    frame = spark.createDataFrame([("a", day(0), 2), ("a", day(0), 3), ("a", day(1), 9)], "k string, ds date, y int")
    for steps, value in (("sum", 5), ("max", 3), ("min", 2)):
        assert series.target_lag(frame, key="k", steps=steps).first().lag1 == value


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_exact_median(spark, n):
    values = [random.Random(n).random() for _ in range(n)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert order_stats.exact_median(frame, [], "v").first()["median"] == statistics.median(values)


SCORED = "g string, y double, forecast double"


@pytest.fixture
def scored(spark):
    rows = [("a", 4.0, 5.0), ("a", 2.0, 1.0), ("b", 0.0, 3.0), ("b", 10.0, 4.0), ("b", None, 1.0)]
    return spark.createDataFrame(rows, SCORED)


def test_error_measures(scored):
    row = metrics.regression_metrics(scored).first()
    errors, targets = [-1.0, 1.0, -3.0, 6.0], [4.0, 2.0, 0.0, 10.0]
    sse = sum(e * e for e in errors)
    assert row.n == 4
    assert row.mae == pytest.approx(11 / 4)
    assert row.rmse == pytest.approx(math.sqrt(sse / 4))
    assert row.r2 == pytest.approx(1 - sse / (statistics.pvariance(targets) * 4))
    assert row.max_error == 6.0
    assert row.mape == pytest.approx((0.25 + 0.5 + 0.6) / 3)


def test_percentage_errors_skip_zero_targets(scored):
    assert metrics.mdape(scored).first().mdape == pytest.approx(0.5)
    row = scored.agg(
        metrics.weighted_ape().alias("w"),
        metrics.weighted_ape(weight=F.col("y")).alias("wy"),
        metrics.total_ape().alias("t"),
    ).first()
    assert row.w == pytest.approx((0.25 + 0.5 + 0.6) / 3)
    assert row.wy == pytest.approx((1 + 1 + 6) / 16)
    assert row.t == pytest.approx(11 / 16)


def test_swapped_arguments_divide_by_the_forecast(scored):
    assert metrics.mdape(scored, y="forecast", forecast="y").first().mdape == pytest.approx(1.0)


def test_evaluation_by_group_keeps_null_group(spark):
    frame = spark.createDataFrame([("a", 2.0, 1.0), (None, 4.0, 1.0)], SCORED)
    got = {r.g: (r.n, r.mdape) for r in metrics.evaluation(frame, ["g"]).collect()}
    assert got == {"a": (1, 0.5), None: (1, 0.75)}
    assert metrics.evaluation(frame).count() == 1


def test_column_profile(spark):
    frame = spark.createDataFrame([(1, 2.5), (3, None)], "a int, b double")
    got = {r.column: (r.min_value, r.max_value) for r in metrics.column_profile(frame, ["a", "b"]).collect()}
    assert got == {"a": (1.0, 3.0), "b": (2.5, 2.5)}


def test_conformal_rank_is_the_smallest_valid_one(spark):
    for n in (7, 19, 20, 100, 333):
        values = random.Random(n).sample(range(10_000), n)
        frame = spark.createDataFrame([(float(v),) for v in values], "residual double")
        q = conformal.half_width(frame).first().q
        assert q == sorted(values)[math.ceil(round((n + 1) * 0.85, 9)) - 1]


def test_conformal_needs_enough_rows(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(5)], "residual double")
    assert conformal.half_width(frame).first().q is None
    rows = spark.createDataFrame([(1.0, 1.0)], "y double, forecast double")
    assert conformal.with_interval(rows, frame).first().hi_ci is None


def test_conformal_coverage_on_exchangeable_data(spark):
    rng = random.Random(11)
    rows = [(f"s{i}", i % 2, rng.gauss(0, 1 + i % 2), 0.0) for i in range(4000)]
    frame = spark.createDataFrame(rows, "unique_id string, g int, y double, forecast double")
    past = conformal.with_residual(frame.filter("cast(substr(unique_id, 2) as int) < 2000"))
    late = frame.filter("cast(substr(unique_id, 2) as int) >= 2000")
    for by in (None, ["g"]):
        out = conformal.with_interval(late, past, by)
        for r in conformal.coverage(out, by).collect():
            assert 82 < r.coverage_of_interval < 88


def test_interval_report_and_rounding(spark):
    rows = [("s", day(0), 1.0, 1.4, -0.6, 3.5), ("s", day(1), 3.5, 2.5, 1.0, 3.5)]
    frame = spark.createDataFrame(rows, "unique_id string, ds date, y double, forecast double, lo_ci double, hi_ci double")
    assert [r.covered_flag for r in conformal.interval_report(frame).collect()] == [1, 0]
    got = [(r.forecast, r.lo_ci, r.hi_ci) for r in conformal.rounded_forecast(frame).collect()]
    assert got == [(1.0, 0.0, 4.0), (3.0, 1.0, 4.0)]


def test_category_codes_follow_sorted_order(spark):
    words = ["b", "abc", "abd", "ab", "a", "", "zeta", "b"]
    frame = spark.createDataFrame([(w, w[:1]) for w in words] + [(None, None)], "u string, v string")
    codes = encoding.category_codes(frame, ["u", "v"])
    got = {(r.column, r.value): r.code for r in codes.collect()}
    assert got == {
        **{("u", w): i for i, w in enumerate(sorted(set(words)))},
        **{("v", w): i for i, w in enumerate(["", "a", "b", "z"])},
    }
    encoded = encoding.encode(frame, codes, ["u"], unknown="null")
    assert encoded.count() == frame.count()
    assert encoded.filter("u = 'zeta'").first().u_code == 6
    with pytest.raises(Exception):
        encoding.encode(frame, codes, ["u"]).collect()


def test_runs_table(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name, mae in (("r1", 0.95), ("r2", 0.91), ("r3", 0.92)):
        runs.log_run(runs.run_rows(spark, name, {"alpha": 0.1}, {"mae": mae, "rmse": 2}), path)
    table = runs.read_runs(spark, path)
    assert table.count() == 6
    assert runs.best_run(table, "mae", below=0.93).first().run_id == "r2"
    assert runs.best_run(table, "mae", below=0.5).count() == 0


def test_best_score(spark):
    history = spark.createDataFrame([(10, 2.0), (20, 1.0), (30, 1.0)], "iterations int, score double")
    row = runs.best_score(history).first()
    assert (row.best_score, row.best_iteration) == (1.0, 20)
