import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from hemline.operators import conformal, forecast, metrics, series

TRENDS = ["linen"]
NUMERIC = forecast.numeric_columns(TRENDS)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(1)
    rows = []
    for s in range(60):
        level = rng.choice([1.0, 3.0])
        for w in range(8):
            day = dt.date(2019, 1, 7) + dt.timedelta(7 * w)
            demand = max(0, round(rng.gauss(level * 4, 1)))
            rows.append(
                (f"s{s:02}", day, demand, 2 + w, 2019, day.month, s % 5, w, 2019, 1, 7, 2, 2, 9.9, 0.1 if w else None)
                + ("dress" if level > 2 else "skirt", "red", "linen", "SS", 10 * w, w, float(w % 3), [0.5, float(s)])
            )
    names = ["unique_id", "ds", "y", *forecast.CALENDAR_AND_PRICE, *forecast.CATEGORICAL, *forecast.CUSTOMER, *TRENDS, "embed"]
    table = spark.createDataFrame(rows, names).withColumns(
        {"y": F.col("y").cast("int"), "embed": F.col("embed").cast("array<float>")}
    )
    return forecast.model_frame(table, TRENDS, key="unique_id", steps="unique").cache()


def test_model_frame_is_leak_safe(frame):
    assert not {"linen", *forecast.CUSTOMER} & set(NUMERIC)
    assert "linen_lag1" in NUMERIC and "lag1" not in frame.columns
    assert frame.filter("ds = '2019-01-07'").count() == 0
    assert frame.count() == 60 * 7


def test_unique_and_repeated_steps_agree(spark, frame):
    source = frame.drop("y0", *forecast.lag_names([*forecast.CUSTOMER, *TRENDS]))
    a = forecast.model_frame(source, TRENDS, key="unique_id", steps="unique")
    b = forecast.model_frame(source, TRENDS, key="unique_id", steps="max")
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count()


def test_tweedie_beats_the_lag_forecast(frame):
    past, late = forecast.split_by_date(frame, "2019-02-18")
    model = forecast.train(past, NUMERIC)
    scored = model.score(late)
    ours = metrics.regression_metrics(scored, y="y0").first().rmse
    naive = series.target_lag(frame.withColumn("y", F.col("y0").cast("double")), "y0", key="unique_id", steps="unique").filter("ds >= '2019-02-18'")
    theirs = metrics.regression_metrics(naive.withColumn("forecast", F.col("lag1").cast("double")), y="y0").first().rmse
    assert ours < theirs
    assert scored.filter("forecast < 0").count() == 0


def test_forecast_table_and_coverage(frame):
    old = frame.filter("ds < '2019-02-04'")
    held = frame.filter("ds >= '2019-02-04' AND ds < '2019-02-18'")
    late = frame.filter("ds >= '2019-02-18'")
    model = forecast.train(old, NUMERIC)
    out = forecast.forecast_table(model, late, held)
    assert out.columns[:5] == ["unique_id", "ds", "forecast", "hi_ci", "lo_ci"]
    assert out.count() == late.count()
    assert out.filter("lo_ci < 0 OR lo_ci > hi_ci OR forecast <> round(forecast)").count() == 0
    residuals = conformal.with_residual(model.score(held), "y0")
    exact = conformal.with_interval(model.score(late), residuals)
    assert conformal.coverage(exact, y="y0").first().coverage_of_interval > 70


def test_unknown_category_is_an_error(frame):
    model = forecast.train(frame, NUMERIC)
    strange = frame.withColumn("category", F.lit("cape"))
    with pytest.raises(Exception):
        model.score(strange).agg(F.sum("forecast")).collect()


def test_saved_model_scores_the_same(spark, frame, tmp_path):
    model = forecast.train(frame, NUMERIC)
    model.save(str(tmp_path / "m"))
    again = forecast.load_model(spark, str(tmp_path / "m"), NUMERIC)
    total = lambda m: m.score(frame).agg(F.sum("forecast")).first()[0]
    assert total(again) == pytest.approx(total(model))


def test_sql_predict_function(spark, frame):
    model = forecast.train(frame, NUMERIC)
    forecast.register_predict(spark, model)
    forecast.feature_array(model, frame).createOrReplaceTempView("inputs")
    got = spark.sql("SELECT sum(predict(features)) AS s FROM inputs").first().s
    assert got == pytest.approx(model.score(frame).agg(F.sum("forecast")).first()[0])


def test_trees_and_embeddings(frame):
    model = forecast.train(frame, NUMERIC, "tree", {"maxIter": 3, "maxDepth": 3}, embed="embed")
    scored = model.score(frame)
    assert scored.count() == frame.count()
    error = metrics.regression_metrics(scored, y="y0").first().rmse
    spread = frame.agg(F.stddev_pop("y0")).first()[0]
    assert error < spread


def test_rolling_origin_and_search(frame):
    scores = forecast.rolling_origin(frame, NUMERIC, [{"regParam": 0.01}], n_windows=2, key="unique_id", steps="unique").collect()
    assert [(r.trial, r.window, r.n) for r in scores] == [(0, 1, 60), (0, 2, 60)]
    found = forecast.search(frame, NUMERIC, n_trials=2, n_windows=1, key="unique_id", steps="unique").collect()
    assert found[0].score <= found[1].score and found[0].n_windows == 1


def test_naive_rolling_rmse(spark):
    rows = [("a", dt.date(2019, 1, 7) + dt.timedelta(7 * i), float(i), 0.0) for i in range(5)]
    out = forecast.naive_rolling_rmse(spark.createDataFrame(rows, "unique_id string, ds date, y double, forecast double"), 2, key="unique_id", steps="unique")
    assert {(r.window, r.rmse) for r in out.collect()} == {(1, 4.0), (2, 3.0)}


def test_sampled_parameters_stay_in_range():
    for space in (forecast.TWEEDIE_SPACE, forecast.TREE_SPACE):
        draws = forecast.sample_params(space, 50)
        assert draws == forecast.sample_params(space, 50)
        for name, (low, high, kind) in space.items():
            values = [d[name] for d in draws]
            assert all(low <= v <= high or math.isclose(v, low) for v in values)
            assert kind != "int" or all(isinstance(v, int) for v in values)
            assert kind != "flag" or all(isinstance(v, bool) for v in values)


def test_split_by_ids(spark, frame):
    ids = spark.createDataFrame([("s01",), ("s02",)], "unique_id string")
    others = frame.select("unique_id").distinct().join(ids, "unique_id", "left_anti")
    past, late = forecast.split_by_ids(frame, others, ids)
    assert late.select("unique_id").distinct().count() == 2
    assert past.count() + late.count() == frame.count()


@pytest.mark.parametrize("n_labels,kind", [(65, "tree"), (4200, "tweedie"), (4200, "tree"), (200_000, "tweedie")])
def test_any_number_of_labels(spark, frame, n_labels, kind):
    wide = frame.limit(1).drop("fabric").crossJoin(
        spark.range(n_labels).select(F.format_string("Fabric#%08d", "id").alias("fabric"), (F.col("id") % 7).alias("extra"))
    ).withColumn("y0", F.col("y0") + F.col("extra"))
    model = forecast.train(wide, NUMERIC, kind, {"maxIter": 2, "maxDepth": 2} if kind == "tree" else {"maxIter": 3})
    assert model.score(wide).filter("forecast IS NOT NULL").count() == n_labels


def test_custom_metric_and_early_stop(frame):
    def largest(y, forecast_column):
        return F.max(F.abs(F.col(y) - F.col(forecast_column)))

    trials = [{"regParam": 0.01}, {"regParam": 1e6}]
    scores = forecast.rolling_origin(
        frame, NUMERIC, trials, 3, metric=largest, key="unique_id", patience=1, steps="unique"
    ).collect()
    assert [r.window for r in scores if r.trial == 0] == [1, 2, 3]
    assert len([r for r in scores if r.trial == 1]) < 3
