"""Grouped-map forecasting: any pandas model, one call per series, spread over the cluster.

For models that built-in functions cannot express. A group holds one row per calendar day at most
(rows of a day are added up before the shuffle), two columns wide, so it always fits its worker.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from seriesmill.operators.forecast import (
    DAY_ZERO,
    INDEX_FLOOR,
    TREND_FLOOR,
    ForecastSpec,
    observations,
    task_count,
    up_to_cutoffs,
)
from seriesmill.operators.placement import TASK, place_by_cost

# (history with ds and y by day, days to predict, settings) -> ds, yhat, yhat_lower, yhat_upper
FitPredict = Callable[[pd.DataFrame, pd.DatetimeIndex, ForecastSpec], pd.DataFrame]
BOUNDS = ["yhat", "yhat_lower", "yhat_upper"]


def grouped_forecast(
    sales: DataFrame,
    keys: Sequence[str],
    spec: ForecastSpec,
    fit_predict: FitPredict,
    n_partitions: int | None = None,
    cutoffs: Sequence[dt.date | str] | None = None,
    literals: Mapping[str, object] | None = None,
    cost: str | None = None,
) -> DataFrame:
    """Run ``fit_predict`` once per series (and cutoff): keys, ds, yhat, yhat_lower, yhat_upper.

    ``literals`` are settings by name that ride along as constant grouping columns and replace
    those of ``spec`` inside the task; they are not part of the result.

    Series are spread by hash, all cutoffs of one in one task. ``cost``, as SQL over ``n`` (days of a series up to
    its cutoff), spreads series and cutoffs one by one so that tasks cost about the same; it pays where few series
    cost much more than others, since rows are then moved once per cutoff.
    """
    n_partitions = n_partitions or task_count(sales.sparkSession)
    # Neutral names in between, so that a key may be called like a column used inside.
    outer, keys = list(keys), [f"_key{n}" for n in range(len(keys))]
    sales = sales.select("date", "sales", *[F.col(f"`{k}`").alias(i) for k, i in zip(outer, keys)])
    if spec.origin == "cutoff" and cutoffs is None:
        raise ValueError("origin='cutoff' needs cutoffs")
    obs = observations(sales, keys).withColumn("y", F.col("y").cast("double"))
    group = list(keys)
    if cutoffs is None:
        obs = obs.repartition(n_partitions, *keys) if cost is None else obs
    else:
        obs = up_to_cutoffs(obs, keys, cutoffs, n_partitions)
        group = ["training_date", *keys]
    task = []
    if cost is not None:
        obs, task = place_by_cost(obs, group, n_partitions, cost), [TASK]
    names = list(literals or {})
    schema = StructType(
        [obs.schema[g] for g in group]
        + [StructField("ds", DateType())]
        + [StructField(b, DoubleType()) for b in BOUNDS]
    )

    def one_series(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        key = key[len(task):]
        settings = dataclasses.replace(spec, **dict(zip(names, key[len(group):])))
        history = rows[["ds", "y"]].assign(ds=pd.to_datetime(rows["ds"])).sort_values("ds", ignore_index=True)
        first = pd.Timestamp(key[0]) if settings.origin == "cutoff" else history["ds"].iloc[-1]
        days = pd.date_range(first + pd.Timedelta(days=1), periods=settings.h)
        if settings.include_history:
            days = pd.DatetimeIndex(history["ds"]).append(days)
        out = fit_predict(history, days, settings)[["ds", *BOUNDS]].reset_index(drop=True)
        out["ds"] = pd.to_datetime(out["ds"]).dt.date
        for position, name in enumerate(group):
            out.insert(position, name, key[position])
        return out

    constants = [F.lit(value).alias(name) for name, value in (literals or {}).items()]
    out = obs.groupBy(*task, *group, *constants).applyInPandas(one_series, schema)
    return out.withColumnsRenamed(dict(zip(keys, outer)))


def _result(days: pd.DatetimeIndex, yhat: np.ndarray, residuals: np.ndarray, spec: ForecastSpec) -> pd.DataFrame:
    margin = spec.z * residuals.std(ddof=1) if len(residuals) > 1 else np.nan
    return pd.DataFrame({"ds": days, "yhat": yhat, "yhat_lower": yhat - margin, "yhat_upper": yhat + margin})


def weekday_mean_model(history: pd.DataFrame, days: pd.DatetimeIndex, spec: ForecastSpec) -> pd.DataFrame:
    """Plain baseline: mean of the same weekday, or of all days where that weekday was never seen."""
    by_weekday = history.groupby(history["ds"].dt.dayofweek)["y"].mean()
    overall = history["y"].mean()

    def expected(when: pd.DatetimeIndex) -> np.ndarray:
        return pd.Series(when.dayofweek).map(by_weekday).fillna(overall).to_numpy()

    residuals = history["y"].to_numpy() - expected(pd.DatetimeIndex(history["ds"]))
    return _result(days, expected(days), residuals, spec)


def closed_form_model(history: pd.DataFrame, days: pd.DatetimeIndex, spec: ForecastSpec) -> pd.DataFrame:
    """The model of ``forecast`` for one series in numpy: line, weekday and month indices, normal interval.

    Gives the grouped-map path the same answers as the native one, as a check of either.
    """
    y, seen = history["y"].to_numpy(dtype=float), pd.DatetimeIndex(history["ds"])
    lowest = TREND_FLOOR * abs(y.mean())

    def number(when: pd.DatetimeIndex) -> np.ndarray:
        return (when - pd.Timestamp(DAY_ZERO)).days.to_numpy(dtype=float)

    t = number(seen)
    spread = ((t - t.mean()) ** 2).sum()
    slope = ((t - t.mean()) * (y - y.mean())).sum() / spread if spread else 0.0

    def trend(when: pd.DatetimeIndex) -> np.ndarray:
        return np.maximum(y.mean() + slope * (number(when) - t.mean()), lowest)

    def index(group: np.ndarray, base: np.ndarray, size: int) -> np.ndarray:
        above, below = np.bincount(group, y, size), np.bincount(group, base, size)
        return np.divide(above, below, out=np.ones(size), where=below != 0)

    weekly, yearly = np.ones(7), np.ones(13)
    if spec.weekly:
        weekly = np.maximum(index(seen.dayofweek.to_numpy(), trend(seen), 7), INDEX_FLOOR)
    if spec.yearly:
        yearly = index(seen.month.to_numpy(), trend(seen) * weekly[seen.dayofweek], 13)

    def value(when: pd.DatetimeIndex) -> np.ndarray:
        return trend(when) * weekly[when.dayofweek] * yearly[when.month]

    return _result(days, value(days), y - value(seen), spec)


# Fixed values of the regression model below.
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8  # changepoints lie in this first part of the history
WEEKLY_ORDER = 3
YEARLY_ORDER = 10
CHANGEPOINT_PENALTY = 4.0
SEASON_PENALTY = 1e-4
TOLERANCE = 1e-9  # relative change of the fit at which the alternation stops
MAX_ROUNDS = 1000


def _ridge(features: np.ndarray, target: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    gram = features.T @ features + np.diag(penalty)
    return np.linalg.lstsq(gram, features.T @ target, rcond=None)[0]


def _waves(day: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2.0 * np.pi * np.outer(day / period, np.arange(1, order + 1))
    return np.hstack([np.sin(angles), np.cos(angles)])


def piecewise_seasonal_model(history: pd.DataFrame, days: pd.DatetimeIndex, spec: ForecastSpec) -> pd.DataFrame:
    """Piecewise-linear trend times one plus Fourier seasonality, by alternating ridge regressions.

    The family of models is that of Taylor and Letham, "Forecasting at Scale" (2018); the fit is
    least squares and the interval normal, so a series always gives the same result.
    """
    y = history["y"].to_numpy(dtype=float)
    origin = history["ds"].iloc[0]
    past = (history["ds"] - origin).dt.days.to_numpy(dtype=float)
    ahead = (days - origin).days.to_numpy(dtype=float)
    span = max(past[-1], 1.0)
    scale = max(np.abs(y).max(), 1e-9)
    knots = np.linspace(0.0, CHANGEPOINT_RANGE, N_CHANGEPOINTS + 2)[1:-1]

    def trend_features(day: np.ndarray) -> np.ndarray:
        t = day[:, None] / span
        return np.hstack([np.ones_like(t), t, np.maximum(t - knots, 0.0)])

    def season_features(day: np.ndarray) -> np.ndarray:
        absolute = day + (origin - pd.Timestamp("1970-01-01")).days
        parts = [np.empty((len(day), 0))]
        if spec.weekly:
            parts.append(_waves(absolute, 7.0, WEEKLY_ORDER))
        if spec.yearly:
            parts.append(_waves(absolute, 365.25, YEARLY_ORDER))
        return np.hstack(parts)

    A, S, target = trend_features(past), season_features(past), y / scale
    trend_penalty = np.r_[0.0, 0.0, np.full(N_CHANGEPOINTS, CHANGEPOINT_PENALTY)]
    season_penalty = np.full(S.shape[1], SEASON_PENALTY)
    season, beta = np.zeros(len(y)), np.zeros(S.shape[1])
    before = np.full(len(y), np.inf)
    for _ in range(MAX_ROUNDS):
        gamma = _ridge(A * (1.0 + season)[:, None], target, trend_penalty)
        level = A @ gamma
        if S.shape[1]:
            beta = _ridge(S * level[:, None], target - level, season_penalty)
            season = S @ beta
        fit = level * (1.0 + season)
        if np.abs(fit - before).max() <= TOLERANCE * max(np.abs(fit).max(), 1e-9):
            break
        before = fit
    fitted = scale * (A @ gamma) * (1.0 + season)
    yhat = scale * (trend_features(ahead) @ gamma) * (1.0 + season_features(ahead) @ beta)
    return _result(days, yhat, y - fitted, spec)
