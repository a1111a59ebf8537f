"""Lags and targets per series.

A series is named by columns, NULL being a value like any other; the text id is output only, because it is NULL
as soon as one part is, and unlike parts can run into the same text.

Lags are positional: a missing week shifts them. ``steps="unique"`` is for panels that hold one row per
series and date, as anything built by grouping on them does; a window partition is then bounded by the
calendar. For any other frame ``steps`` names how the rows of one series and date become one value
(``"sum"``, ``"max"``, ``"min"`` or ``"avg"``): the shifted columns are reduced with a map-side aggregate, shifted,
and joined back, so every row stays and copies of a hot series never meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemline.operators.joins import null_safe_join

# The columns of the feature table that name a series, and its date.
SERIES = ["external_code", "retail", "release_year", "release_month", "release_day"]
STEP = "ds"
REDUCTIONS = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}
Key = str | list[str]


def _keys(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _filled(c: Column, dtype: str, fill: float | None) -> Column:
    if fill is None:
        return c
    if dtype in ("double", "float"):
        c = F.nanvl(c, F.lit(fill).cast(dtype))
    return F.coalesce(c, F.lit(fill).cast(dtype))


def shifted(
    df: DataFrame,
    added: dict[str, Column],
    sources: list[str],
    key: Key = SERIES,
    order: str = STEP,
    *,
    steps: str,
) -> DataFrame:
    """Adds window columns that are functions of ``sources`` along a series, in one exchange and sort."""
    if steps == "unique":
        return df.withColumns(added)
    if steps not in REDUCTIONS:
        raise ValueError(f"steps must be 'unique' or one of {sorted(REDUCTIONS)}, not {steps!r}")
    step = [*_keys(key), order]
    reduced = [REDUCTIONS[steps](c).alias(c) for c in sources]
    per_step = df.groupBy(*step).agg(*reduced) if reduced else df.select(*step).distinct()
    return with_lagged(df, per_step.select(*step, *[c.alias(n) for n, c in added.items()]), step)


def with_lagged(df: DataFrame, lagged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Base rows joined with lag columns computed elsewhere."""
    return null_safe_join(df, lagged, keys or [*SERIES, STEP])


def exog_lag_columns(
    df: DataFrame,
    columns: list[str],
    lags: tuple[int, ...] = (1, 2),
    key: Key = SERIES,
    order: str = STEP,
    fill: float | None = -1,
) -> dict[str, Column]:
    """``{column}_lag{k}``; missing history, and a NULL or NaN in the lagged value, become ``fill``."""
    types = dict(df.dtypes)
    w = Window.partitionBy(*_keys(key)).orderBy(order)
    return {f"{c}_lag{k}": _filled(F.lag(c, k).over(w), types[c], fill) for c in columns for k in lags}


def target_lag_columns(
    target: str = "y", lag: int = 1, key: Key = SERIES, order: str = STEP
) -> dict[str, Column]:
    w = Window.partitionBy(*_keys(key)).orderBy(order)
    return {f"lag{lag}": F.lag(target, lag).over(w)}


def exog_lags(
    df: DataFrame,
    columns: list[str],
    lags: tuple[int, ...] = (1, 2),
    key: Key = SERIES,
    order: str = STEP,
    fill: float | None = -1,
    *,
    steps: str,
) -> DataFrame:
    added = exog_lag_columns(df, columns, lags, key, order, fill)
    return shifted(df, added, columns, key, order, steps=steps)


def drop_warm_up(df: DataFrame, lag: int = 1, keep_lag: bool = True) -> DataFrame:
    """Without the rows at the start of a series that have no target lag.

    ``keep_lag=False`` also drops the lag itself: it is then no model input.
    """
    out = df.filter(F.col(f"lag{lag}").isNotNull())
    return out if keep_lag else out.drop(f"lag{lag}")


def target_lag(
    df: DataFrame,
    target: str = "y",
    lag: int = 1,
    key: Key = SERIES,
    order: str = STEP,
    keep_lag: bool = True,
    *,
    steps: str,
) -> DataFrame:
    """Adds ``lag{k}`` of the target and drops the warm-up rows."""
    added = target_lag_columns(target, lag, key, order)
    return drop_warm_up(shifted(df, added, [target], key, order, steps=steps), lag, keep_lag)


def horizon_target(
    df: DataFrame,
    target: str = "y",
    horizon: int = 1,
    key: Key = SERIES,
    order: str = STEP,
    *,
    steps: str,
) -> DataFrame:
    """Adds ``y0`` … ``y{horizon-1}``: the target 0 … horizon-1 steps ahead."""
    out = df.withColumn(f"{target}0", F.col(target))
    if horizon == 1:
        return out
    w = Window.partitionBy(*_keys(key)).orderBy(order)
    ahead = {f"{target}{h}": F.lead(target, h).over(w) for h in range(1, horizon)}
    return shifted(out, ahead, [target], key, order, steps=steps)


def steps_from_end(
    df: DataFrame, key: Key = SERIES, order: str = STEP, name: str = "back", *, steps: str
) -> DataFrame:
    """1 for the last step of a series, 2 for the one before it, and so on."""
    w = Window.partitionBy(*_keys(key)).orderBy(F.desc(order))
    return shifted(df, {name: F.row_number().over(w)}, [], key, order, steps=steps)


def clip_target(df: DataFrame, target: str = "y") -> DataFrame:
    """Negative targets become 0, NULL stays."""
    return df.withColumn(target, F.when(F.col(target) < 0, 0).otherwise(F.col(target)))
