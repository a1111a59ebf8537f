"""Weekly demand model: feature frame, training, scoring, back-testing, parameter search.

The training frame is written once to the shared folder, because an iterative fit reads it many times
and a lost executor must not recompute the joins and windows behind it. Model coefficients and one score per
trial and window are all that reaches the driver.

A category column is one number whatever its labels are: trees get its ordinal code, linear models the smoothed mean target
of its training rows. Both come from a dictionary table that is joined in, so neither the model nor the driver
grows with the labels.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hemline.operators import backtest, boosting, conformal, encoding, series
from hemline.session import written

# The columns of the model.
CATEGORICAL = ["category", "color", "fabric", "season_category"]
CALENDAR_AND_PRICE = [
    "current_week_of_year",
    "current_year",
    "current_month",
    "retail",
    "week",
    "release_year",
    "release_month",
    "release_day",
    "release_day_of_week",
    "release_week_of_year",
    "price",
    "discount",
]
CUSTOMER = ["retail_total_sales_qty", "retail_total_customer_purchase"]
LAGS = (1, 2)
MISSING = -1

# Parameters of the trained model.
TWEEDIE_POWER = 1.3596343351145384
TREE_PARAMS = {"maxIter": 250, "maxDepth": 11, "stepSize": 0.07, "subsamplingRate": 0.7413694185041535}
SEED = 7113
# In a back-test of squared-loss trees one row in so many decides when they stop growing, and the relative gain that goes on.
HELD_EVERY = 10
EARLY_STOP_GAIN = 0.001
N_WINDOWS = 10
N_TRIALS = 5

# Draws of which a led search takes one.
CANDIDATES = 24

# Rows that the mean target of a label is pulled to the overall mean by.
PRIOR_ROWS = 20

# Search ranges as (low, high, kind).
TWEEDIE_SPACE = {
    "variancePower": (1.1, 1.499, "log"),
    "regParam": (1e-8, 10.0, "log"),
    "maxIter": (10, 50, "int"),
    "fitIntercept": (0, 1, "flag"),
}
BOOSTED_SPACE = {
    "power": (1.1, 1.499, "log"),
    "l1": (1e-8, 10.0, "log"),
    "l2": (1e-8, 10.0, "log"),
    "leaves": (2, 30, "int"),
    "depth": (2, 25, "int"),
    "feature_share": (0.4, 1.0, "float"),
    "row_share": (0.4, 1.0, "float"),
    "rows_every": (1, 7, "int"),
    "least_rows": (1, 3, "int"),
}
# Step size of the trees of a search.
SEARCH_RATE = 0.10
TREE_SPACE = {
    "stepSize": (0.05, 0.1, "log"),
    "maxDepth": (2, 25, "int"),
    "maxIter": (50, 250, "int"),
    "subsamplingRate": (0.4, 1.0, "float"),
    "minInstancesPerNode": (1, 3, "int"),
    "minInfoGain": (1e-8, 10.0, "log"),
    "maxBins": (32, 256, "int"),
}


def lag_names(columns: list[str], lags: Iterable[int] = LAGS) -> list[str]:
    return [f"{c}_lag{k}" for c in columns for k in lags]


def numeric_columns(trends: list[str]) -> list[str]:
    """Numeric model inputs. Same-week customer and trend values are left out, only lags are known."""
    return [*CALENDAR_AND_PRICE, *lag_names([*CUSTOMER, *trends])]


def model_frame(
    features: DataFrame, trends: list[str], horizon: int = 1, key: series.Key = series.SERIES, *, steps: str
) -> DataFrame:
    """Lagged signals, clipped target, warm-up row dropped, ``y0`` as the label.

    All lags share one partitioning and order, so they cost one exchange and sort. ``steps`` as in
    ``series``: "unique" when the table holds one row per series and date.
    """
    signals = [*CUSTOMER, *trends]
    frame = series.clip_target(features)
    added = {
        **series.exog_lag_columns(frame, signals, LAGS, key, fill=MISSING),
        **series.target_lag_columns(key=key),
    }
    lagged = series.shifted(frame, added, [*signals, "y"], key, steps=steps)
    targets = series.drop_warm_up(lagged, keep_lag=False)
    return series.horizon_target(targets, "y", horizon, key, steps=steps)


def _filled(df: DataFrame, numeric: list[str]) -> DataFrame:
    doubles = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(MISSING)), F.lit(MISSING)) for c in numeric}
    return df.withColumns({f"x_{c}": v for c, v in doubles.items()})


@dataclass
class Preparation:
    """Fitted encoding of the categorical and numeric inputs into one vector.

    ``codes`` is the dictionary (column, value, code, mean_target), written; ``code`` the one of its numbers that the
    model gets.
    """

    numeric: list[str]
    codes: DataFrame
    code: str
    model: PipelineModel
    embed: str | None = None

    def encoded(self, df: DataFrame) -> DataFrame:
        frame = _filled(df, self.numeric)
        if self.embed:
            frame = frame.withColumn("_embed", array_to_vector(F.col(self.embed).cast("array<double>")))
        return encoding.encode(frame, self.codes, CATEGORICAL, "_number", self.code)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features``. A label that the training rows lack is an error."""
        return self.vectors(self.encoded(df))

    def arrays(self, df: DataFrame) -> DataFrame:
        """As :meth:`transform`, with ``features`` as an array."""
        return self._array(self.encoded(df)).drop(*self.inputs())

    def numbers(self) -> list[Column]:
        """The numbers of an encoded row as the model gets them: standardised for linear models, for trees as they are."""

        def known(c: str) -> Column:
            return F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"{c}: a label that the training rows lack")).cast("double"))

        plain = [*[F.col(f"x_{c}") for c in self.numeric], *[known(f"{c}_number") for c in CATEGORICAL]]
        scaler = next((s for s in self.model.stages if isinstance(s, StandardScalerModel)), None)
        if scaler is None:
            return plain
        factors = [1 / s if s else 0.0 for s in scaler.std.toArray().tolist()]
        return [(c - F.lit(m)) * F.lit(f) for c, m, f in zip(plain, scaler.mean.toArray().tolist(), factors, strict=True)]

    def _array(self, encoded: DataFrame) -> DataFrame:
        numbers = F.array(*self.numbers())
        return encoded.withColumn("features", F.concat(numbers, vector_to_array("_embed")) if self.embed else numbers)

    def inputs(self) -> list[str]:
        """The columns that :meth:`encoded` adds."""
        return [*[f"x_{c}" for c in self.numeric], *[f"{c}_number" for c in CATEGORICAL], *(["_embed"] if self.embed else [])]

    def vectors(self, encoded: DataFrame) -> DataFrame:
        """``features`` in place of the inputs."""
        return self.model.transform(encoded).drop(*self.inputs(), "_numbers", "_scaled")

    def stored(self, df: DataFrame, kept: list[str], name: str) -> DataFrame:
        """``features``, an array, and the columns ``kept``, from inputs that are written once.

        Each input is a column of its own in the files, with few values or long runs of one, and so takes less place than in
        vectors.
        """
        return self._array(written(self.encoded(df).select(*self.inputs(), *kept), name)).select("features", *kept)


def label_numbers(train: DataFrame, target: str = "y0") -> DataFrame:
    """(column, value, code, mean_target) of all category columns: ordinal code and smoothed mean of the target."""
    codes = encoding.category_codes(train, CATEGORICAL)
    long = train.select(*[F.col(c).cast("string").alias(c) for c in CATEGORICAL], F.col(target).cast("double").alias("_y"))
    sums = (
        long.unpivot(["_y"], CATEGORICAL, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("_y").alias("n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("total"))
    )
    overall = train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0
    mean = (F.col("total") + PRIOR_ROWS * F.lit(overall)) / (F.col("n") + PRIOR_ROWS)
    return codes.join(sums, ["column", "value"]).select("column", "value", "code", mean.alias("mean_target"))


def fit_preparation(
    train: DataFrame, numeric: list[str], linear: bool = True, embed: str | None = None
) -> Preparation:
    """Linear models get mean targets and standardised numbers; trees get ordinal codes and numbers as they are."""
    code = "mean_target" if linear else "code"
    start = Preparation(numeric, written(label_numbers(train), "labels"), code, PipelineModel([]), embed)
    numbers = [*[f"x_{c}" for c in numeric], *[f"{c}_number" for c in CATEGORICAL]]
    stages = [VectorAssembler(inputCols=numbers, outputCol="_numbers")]
    inputs = ["_numbers"]
    if linear:
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        inputs = ["_scaled"]
    stages.append(VectorAssembler(inputCols=[*inputs, *(["_embed"] if embed else [])], outputCol="features"))
    return replace(start, model=Pipeline(stages=stages).fit(start.encoded(train)))


#: Settings of a Tweedie model that its parameters don't name.
TWEEDIE_SETTINGS = {"variancePower": TWEEDIE_POWER, "regParam": 1e-3, "maxIter": 25, "fitIntercept": True}


@dataclass(frozen=True)
class LinearModel:
    """A Tweedie model with log link: the forecast is the exponential of a weighted sum of the inputs."""

    coefficients: DenseVector
    intercept: float

    def forecast(self, encoded: DataFrame, prep: Preparation) -> Column:
        """The forecast as an expression over the inputs' columns, without vectors."""
        weights, numbers = self.coefficients.toArray().tolist(), prep.numbers()
        if prep.embed:
            vector = vector_to_array("_embed")
            numbers = [*numbers, *[vector[i] for i in range(len(weights) - len(numbers))]]
        return F.exp(reduce(lambda a, b: a + b, [F.lit(w) * c for w, c in zip(weights, numbers, strict=True)], F.lit(self.intercept)))

    def save(self, spark: SparkSession, path: str) -> None:
        row = [(self.coefficients.toArray().tolist(), self.intercept)]
        spark.createDataFrame(row, "coefficients array<double>, intercept double").write.mode("overwrite").parquet(path)


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    row = spark.read.parquet(path).first()
    return LinearModel(Vectors.dense(row["coefficients"]), row["intercept"])


def fit_tweedie(rows: DataFrame, params: dict | None = None) -> LinearModel:
    """The model of :func:`tweedie_regressor` from (features, an array; y0), one aggregation of summed products for each of its steps."""
    p = {**TWEEDIE_SETTINGS, **(params or {})}
    y = F.col("y0").cast("double")
    checked = F.when(y < 0, F.raise_error(F.lit("a target is below zero")).cast("double")).otherwise(y)
    data = rows.select(F.col("features").alias("values"), checked.alias("y"), F.lit(1).alias("back"))
    first = rows.select(F.size("features")).first()
    if first is None:
        raise ValueError("no row to learn from")
    model = backtest.Linear(p["variancePower"], p["regParam"], p["maxIter"], p["fitIntercept"], 0)
    backtest.fit_linear(data, [model], first[0])
    return LinearModel(Vectors.dense(model.weights[1:]), float(model.weights[0]))


def tweedie_regressor(params: dict | None = None) -> GeneralizedLinearRegression:
    """Tweedie loss with a log link."""
    settings = {**TWEEDIE_SETTINGS, **(params or {})}
    return GeneralizedLinearRegression(
        family="tweedie",
        linkPower=0.0,
        featuresCol="features",
        labelCol="y0",
        predictionCol="forecast",
        **settings,
    )


def tree_regressor(params: dict | None = None, early_stop: bool = False) -> GBTRegressor:
    """Boosted trees with squared loss. With ``early_stop`` growing ends where the held rows (``_held``) gain no more."""
    settings = {**TREE_PARAMS, "seed": SEED, "maxBins": 64, **(params or {})}
    if early_stop:
        settings |= {"validationIndicatorCol": "_held", "validationTol": EARLY_STOP_GAIN}
    return GBTRegressor(featuresCol="features", labelCol="y0", predictionCol="forecast", **settings)


def label_inputs(numeric: list[str]) -> set[int]:
    """Places of the category codes among the inputs."""
    return set(range(len(numeric), len(numeric) + len(CATEGORICAL)))


def with_held_rows(rows: DataFrame) -> DataFrame:
    """Marks one row in ``HELD_EVERY`` by a hash of its vector, for the early stop of trees."""
    return rows.withColumn("_held", F.pmod(F.xxhash64("features", "y0"), F.lit(HELD_EVERY)) == 0)


@dataclass
class DemandModel:
    preparation: Preparation
    regressor: object
    params: dict = field(default_factory=dict)

    def score(self, frame: DataFrame) -> DataFrame:
        """Adds ``forecast`` and keeps every input column, so nothing has to be joined back."""
        if isinstance(self.regressor, boosting.Forest):
            return self.regressor.transform(self.preparation.arrays(frame)).drop("features")
        if isinstance(self.regressor, LinearModel):
            encoded = self.preparation.encoded(frame)
            return encoded.withColumn("forecast", self.regressor.forecast(encoded, self.preparation)).drop(*self.preparation.inputs())
        return self.regressor.transform(self.preparation.transform(frame)).drop("features")

    def save(self, path: str) -> None:
        prep, spark = self.preparation, self.preparation.codes.sparkSession
        own = {boosting.Forest: "trees", LinearModel: "linear"}.get(type(self.regressor))
        stages = [prep.model] if own else [prep.model, self.regressor]
        PipelineModel(stages=stages).write().overwrite().save(f"{path}/model")
        if own:
            self.regressor.save(spark, f"{path}/{own}")
        prep.codes.withColumn("used", F.lit(prep.code)).write.mode("overwrite").parquet(f"{path}/labels")


def load_model(spark: SparkSession, path: str, numeric: list[str], embed: str | None = None) -> DemandModel:
    prepared, *rest = PipelineModel.load(f"{path}/model").stages
    labels = spark.read.parquet(f"{path}/labels")
    used = labels.first()["used"]
    if rest:
        regressor = rest[0]
    else:
        regressor = load_linear(spark, f"{path}/linear") if used == "mean_target" else boosting.load_forest(spark, f"{path}/trees")
    return DemandModel(Preparation(numeric, labels.drop("used"), used, prepared, embed), regressor)


def train(
    frame: DataFrame,
    numeric: list[str],
    kind: str = "tweedie",
    params: dict | None = None,
    embed: str | None = None,
    preparation: Preparation | None = None,
) -> DemandModel:
    """Fit on all rows of ``frame`` (see :func:`model_frame`). The inputs are written once, for "tree" the vectors; the fit reads nothing
    else.

    ``kind``: "tweedie", a linear model with Tweedie loss; "boosted", trees with Tweedie loss (``params`` as in
    ``boosting.TreeParams``); "tree", trees with squared loss.
    """
    linear = kind == "tweedie"
    known = frame.filter(F.col("y0").isNotNull())
    prep = preparation or fit_preparation(known, numeric, linear, embed)
    if kind == "boosted":
        rows = prep.stored(known, ["y0"], "training")
        fitted = boosting.fit(rows, label_inputs(numeric), boosting.TreeParams(**(params or {})))
    elif linear:
        fitted = fit_tweedie(prep.stored(known, ["y0"], "training"), params)
    else:
        rows = written(prep.transform(known).select("features", "y0"), "training")
        fitted = tree_regressor(params).fit(rows)
    return DemandModel(prep, fitted, dict(params or {}))


def register_predict(spark: SparkSession, model: DemandModel, name: str = "predict") -> Callable:
    """A SQL function from the feature vector (as an array) to the forecast of a Tweedie model, linear or boosted.

    Rows of an Arrow batch are worked on together: a product for a linear model, one descent of all rows per tree for trees.
    """
    if isinstance(model.regressor, boosting.Forest):
        predict = model.regressor.function()
        spark.udf.register(name, predict)
        return predict
    weights = np.asarray(model.regressor.coefficients.toArray())
    intercept = float(model.regressor.intercept)

    @pandas_udf("double")
    def predict(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(np.exp(np.stack(vectors.to_numpy()) @ weights + intercept))

    spark.udf.register(name, predict)
    return predict


def feature_array(model: DemandModel, frame: DataFrame) -> DataFrame:
    prepared = model.preparation.transform(frame)
    return prepared.withColumn("features", vector_to_array("features"))


def split_by_ids(
    frame: DataFrame, train_ids: DataFrame, test_ids: DataFrame, key: str = "unique_id"
) -> tuple[DataFrame, DataFrame]:
    return frame.join(train_ids, key, "left_semi"), frame.join(test_ids, key, "left_semi")


def split_by_date(frame: DataFrame, cut: str, date: str = "ds") -> tuple[DataFrame, DataFrame]:
    return frame.filter(F.col(date) < F.lit(cut).cast("date")), frame.filter(
        F.col(date) >= F.lit(cut).cast("date")
    )


def naive_rolling_rmse(
    scored: DataFrame,
    n_windows: int = N_WINDOWS,
    key: series.Key = series.SERIES,
    y: str = "y",
    forecast: str = "forecast",
    *,
    steps: str,
) -> DataFrame:
    """RMSE per window of a forecast that uses past rows only: no refit, so one pass for all windows."""
    error = F.col(y) - F.col(forecast)
    return (
        series.steps_from_end(scored, key, name="window", steps=steps)
        .filter(F.col("window") <= n_windows)
        .groupBy("window")
        .agg(F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"))
    )


def root_mean_square(y: str, forecast: str) -> Column:
    error = F.col(y) - F.col(forecast)
    return F.sqrt(F.avg(error * error))


_SCORES = "trial int, params map<string,string>, window int, n bigint, score double"


def rolling_origin(
    frame: DataFrame,
    numeric: list[str],
    trials: list[dict],
    n_windows: int = N_WINDOWS,
    kind: str = "tweedie",
    metric: Callable[[str, str], Column] = root_mean_square,
    key: series.Key = series.SERIES,
    patience: int | None = None,
    parallel: int = 4,
    *,
    steps: str,
) -> DataFrame:
    """Back-test: for window w, train on all but the last w rows of every series, test on the next row.

    Returns (trial, params, window, n, score); ``metric`` is an aggregate of the names of target and forecast. Scaling
    and label numbers are fitted on the rows before all test windows. The inputs (for other kinds than the joint ones the prepared
    vectors) are written once; a fit reads only these and the labels.

    Models of the kinds "tweedie" and "boosted" are fitted together, all trials and windows in as many jobs as one fit has steps
    (see ``backtest``). Boosted trees stop on the mean score of their windows: every ``backtest.EVALUATE_EVERY`` trees, after
    ``patience`` looks without a gain (``backtest.PATIENCE`` if not given), at ``backtest.MOST_TREES`` or a trial's own ``trees``.
    For the others ``patience`` makes a trial stop when its mean score has been worse than the best trial's for so many
    windows in a row; then, and for the kind "tree", every fit is a job of its own.
    """
    spark = frame.sparkSession
    ranked = written(series.steps_from_end(frame.filter(F.col("y0").isNotNull()), key, steps=steps), "ranked")
    before = ranked.filter(F.col("back") > n_windows)
    prep = fit_preparation(before if before.head(1) else ranked, numeric, kind == "tweedie")
    safe = replace(prep, codes=_with_unseen(prep.codes, ranked))
    if kind == "boosted" or kind == "tweedie" and patience is None:
        data = safe.stored(ranked, ["y0", "back"], "folds")
    else:
        data = written(with_held_rows(safe.transform(ranked).select("features", "y0", "back")), "folds")
    sizes = {r["back"]: r["n"] for r in data.groupBy("back").agg(F.count("*").alias("n")).filter(
        F.col("back") <= n_windows + 1
    ).collect()}
    usable = [w for w in range(1, n_windows + 1) if sizes.get(w) and sizes.get(w + 1)]
    joint = None
    if kind == "boosted":
        params = [boosting.TreeParams(**{"learning_rate": SEARCH_RATE, **t}) for t in trials]
        most = max((t.get("trees", backtest.MOST_TREES) for t in trials), default=0)
        looks = backtest.PATIENCE if patience is None else patience
        joint = backtest.boosted_folds(data, params, usable, label_inputs(numeric), metric, most, patience=looks)
    elif kind == "tweedie" and patience is None:
        full = [{**TWEEDIE_SETTINGS, **t} for t in trials]
        joint = backtest.linear_folds(data, full, usable, metric)
    if joint is not None:
        texts = [{k: str(v) for k, v in t.items()} for t in trials]
        rows = [(i, texts[i], w, n, score) for i, w, n, score, *_ in joint]
        return spark.createDataFrame(rows, _SCORES)

    def make(params: dict):
        return tweedie_regressor(params) if kind == "tweedie" else tree_regressor(params, early_stop=True)

    def scored(i: int, w: int) -> tuple:
        past, test = data.filter(F.col("back") > w), data.filter(F.col("back") == w)
        score = make(trials[i]).fit(past).transform(test).agg(
            F.count(F.col("y0") - F.col("forecast")).alias("n"), metric("y0", "forecast").alias("score")
        ).first()
        return i, {k: str(v) for k, v in trials[i].items()}, w, score["n"], score["score"]

    if patience is None:
        # The fits don't depend on each other: several run at a time and fill the cluster between one another's steps.
        with ThreadPoolExecutor(parallel) as pool:
            rows = list(pool.map(lambda x: scored(*x), [(i, w) for i in range(len(trials)) for w in usable]))
    else:
        rows, best = [], float("inf")
        for i in range(len(trials)):
            scores, worse = [], 0
            for w in usable:
                rows.append(scored(i, w))
                scores.append(rows[-1][-1])
                worse = worse + 1 if sum(scores) / len(scores) > best else 0
                if worse >= patience:
                    break
            else:
                best = min(best, sum(scores) / len(scores)) if scores else best
    return spark.createDataFrame(rows, _SCORES)


def _with_unseen(codes: DataFrame, frame: DataFrame) -> DataFrame:
    """The dictionary with the labels that only the test windows have: they get code -1 and the mean of all labels."""
    mean = codes.groupBy("column").agg(F.avg("mean_target").alias("mean_target"))
    values = (
        frame.select(*[F.col(c).cast("string").alias(c) for c in CATEGORICAL])
        .unpivot([], CATEGORICAL, "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .join(codes, ["column", "value"], "left_anti")
        .join(mean, "column")
        .select("column", "value", F.lit(-1).alias("code"), "mean_target")
    )
    return written(codes.unionByName(values), "labels")


def sample_params(space: dict, n_trials: int, seed: int = SEED) -> list[dict]:
    """Seeded random draws from the search ranges."""
    rng = random.Random(seed)

    def draw(low, high, kind):
        if kind in ("int", "flag"):
            drawn = rng.randint(low, high)
            return bool(drawn) if kind == "flag" else drawn
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [{name: draw(*limits) for name, limits in space.items()} for _ in range(n_trials)]


def _unit(value, low: float, high: float, kind: str) -> float:
    """A parameter's place in its range, 0 to 1."""
    if kind == "log":
        value, low, high = math.log(value), math.log(low), math.log(high)
    return (float(value) - low) / (high - low) if high > low else 0.0


def _from_unit(place: float, low: float, high: float, kind: str):
    if kind == "log":
        return math.exp(math.log(low) + place * (math.log(high) - math.log(low)))
    value = low + place * (high - low)
    if kind in ("int", "flag"):
        return bool(round(value)) if kind == "flag" else round(value)
    return value


def proposed_params(space: dict, tried: list[tuple[dict, float]], n_trials: int, seed: int = SEED) -> list[dict]:
    """Draws led by earlier trials (params, score): each parameter comes from around the better trials' values, and of some draws the one
    is taken that is likeliest there against all others. Scores that are missing count as worst."""
    rng = random.Random(f"{seed}-{len(tried)}")
    order = sorted(tried, key=lambda t: (t[1] is None or math.isnan(t[1]), t[1] or 0.0))
    n_good = max(2, math.ceil(len(order) / 4))
    good, bad = order[:n_good], order[n_good:]
    if len(order) < 4:
        return sample_params(space, n_trials, rng.randrange(1 << 30))

    def density(place: float, near: list[float], width: float) -> float:
        peaks = sum(math.exp(-((place - c) ** 2) / (2 * width * width)) / (width * math.sqrt(2 * math.pi)) for c in near)
        return (peaks + 1.0) / (len(near) + 1)

    made = []
    for _ in range(n_trials):
        trial = {}
        for name, limits in space.items():
            ups, downs = ([_unit(p[name], *limits) for p, _ in side] for side in (good, bad))
            width = max(0.05, 0.5 / len(ups))
            draws = [min(1.0, max(0.0, rng.gauss(rng.choice(ups), width))) for _ in range(CANDIDATES)]
            best = max(draws, key=lambda u: density(u, ups, width) / density(u, downs, width))
            trial[name] = _from_unit(best, *limits)
        made.append(trial)
    return made


def search(
    frame: DataFrame,
    numeric: list[str],
    n_trials: int = N_TRIALS,
    n_windows: int = N_WINDOWS,
    kind: str = "tweedie",
    space: dict | None = None,
    metric: Callable[[str, str], Column] = root_mean_square,
    key: series.Key = series.SERIES,
    patience: int | None = None,
    rounds: int = 1,
    *,
    steps: str,
) -> DataFrame:
    """Mean score per trial, best first; a trial that was stopped early has fewer windows.

    The trials come in ``rounds``: those of the first are seeded draws, those of later ones are led by the scores so far (see
    :func:`proposed_params`). The trials of a round are fitted together where the kind allows it.
    """
    space = space or {"tweedie": TWEEDIE_SPACE, "boosted": BOOSTED_SPACE, "tree": TREE_SPACE}[kind]
    tried: list[tuple[dict, float]] = []
    parts = []
    for i in range(rounds):
        n = n_trials * (i + 1) // rounds - n_trials * i // rounds
        trials = proposed_params(space, tried, n) if tried else sample_params(space, n)
        found = rolling_origin(frame, numeric, trials, n_windows, kind, metric, key, patience, steps=steps)
        if rounds > 1:
            means = {r["trial"]: r["score"] for r in found.groupBy("trial").agg(F.avg("score").alias("score")).collect()}
            parts.append(found.withColumn("trial", F.col("trial") + len(tried)))
            tried += [(t, means.get(k)) for k, t in enumerate(trials)]
        else:
            parts.append(found)
    scores = reduce(DataFrame.unionByName, parts)
    return (
        scores.groupBy("trial")
        .agg(
            F.first("params").alias("params"),
            F.count("*").alias("n_windows"),
            F.avg("score").alias("score"),
        )
        .orderBy("score", "trial")
    )


def forecast_table(
    model: DemandModel,
    frame: DataFrame,
    calibration: DataFrame,
    alpha: float = conformal.ALPHA,
    by: list[str] | None = None,
) -> DataFrame:
    """Forecast with interval, in whole units, beside all feature columns.

    ``calibration`` is a slice the model was not trained on; passing the training rows gives narrower
    intervals than the level promises.
    """
    residuals = conformal.with_residual(model.score(calibration), "y0")
    scored = conformal.with_interval(model.score(frame), residuals, by, alpha)
    out = conformal.rounded_forecast(scored)
    lead = ["unique_id", "ds", "forecast", "hi_ci", "lo_ci"]
    return out.select(*lead, *[c for c in out.columns if c not in lead])
