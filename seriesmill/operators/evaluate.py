"""Forecasts against actuals: alignment, errors, interval coverage and strategy comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.dates import as_date
from seriesmill.functions.scoring import below_upper, inside_interval, usable
from seriesmill.operators.forecast import KEYS, observations

PER_SERIES = "store_item"
TOP_DOWN = "allocated"


def with_actuals(forecasts: DataFrame, sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Forecast rows that have an actual, with it as ``y``; beside a key of that name it is ``_y``."""
    inner = [f"_key{n}" for n in range(len(keys))]
    named = sales.select("date", "sales", *[F.col(f"`{k}`").alias(i) for k, i in zip(keys, inner)])
    actual = observations(named, inner).withColumnsRenamed({"ds": "_ds", "y": "_y"})
    same = [F.col(f"`{k}`") == F.col(i) for k, i in zip(keys, inner)]
    joined = forecasts.join(actual, [*same, F.col("ds") == F.col("_ds")], "inner").drop("_ds", *inner)
    return joined if "y" in forecasts.columns else joined.withColumnRenamed("_y", "y")


def unscored(sales: DataFrame, forecasts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Actuals that no forecast covers; the inner joins of the scorers leave them out."""
    covered = forecasts.select(*keys, F.col("ds").alias("date"))
    return sales.join(covered, [*keys, "date"], "left_anti").select(sales.columns)


def actual_vs_forecast(
    forecasts: DataFrame, sales: DataFrame, keys: Sequence[str] = KEYS, days: int = 365
) -> DataFrame:
    """The last ``days`` days of each series' history and everything after them, with actuals where known."""
    actual = observations(sales, keys)
    last = actual.groupBy(*keys).agg(F.max("ds").alias("last_ds"))
    recent = forecasts.join(last, list(keys)).where(F.col("ds") > F.date_sub("last_ds", days))
    return recent.join(actual, [*keys, "ds"], "left").select(
        *keys, "ds", "y", "yhat", "yhat_lower", "yhat_upper"
    )


def prediction_overview(test: DataFrame, series_forecast: DataFrame, allocated: DataFrame) -> DataFrame:
    """Actual, both forecasts and their differences per store, item and day known to all three."""
    key = ["date", "store", "item"]
    actual = test.select(*key, F.col("sales").alias("y"))
    direct = series_forecast.select(
        F.col("ds").alias("date"), "store", "item", "yhat", "yhat_lower", "yhat_upper"
    )
    top_down = allocated.select(F.col("ds").alias("date"), "store", "item", F.col("yhat").alias("yhat_agg"))
    y, yhat, yhat_agg = F.col("y").cast("double"), F.col("yhat"), F.col("yhat_agg")
    return actual.join(direct, key).join(top_down, key).select(
        *key, "y", "yhat", "yhat_lower", "yhat_upper", "yhat_agg",
        (yhat - yhat_agg).alias("pred_diff"),
        (y - yhat).alias("miss"),
        (y - yhat_agg).alias("agg_miss"),
    )


def _errors() -> list[Column]:
    error = usable(F.col("y")) - usable(F.col("yhat"))
    mse = F.avg(error * error)
    return [mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(error)).alias("mae")]


def error_metrics(pairs: DataFrame, keys: Sequence[str] = KEYS, model: str | None = None) -> DataFrame:
    """Errors per group of (y, yhat) pairs, as plain aggregates with partial sums.

    ``n`` counts the scored pairs and ``n_null`` those without a value or a forecast.
    """
    scored = usable(F.col("y")).isNotNull() & usable(F.col("yhat")).isNotNull()
    out = pairs.groupBy(*keys).agg(
        F.count_if(scored).alias("n"), F.count_if(~scored).alias("n_null"), *_errors()
    )
    return out if model is None else out.withColumn("model", F.lit(model))


def fit_metrics(
    forecasts: DataFrame, sales: DataFrame, before: dt.date | str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """In-sample errors over all rows before a day: mae, mse, rmse."""
    past = F.col("ds") < F.lit(as_date(before))
    pairs = with_actuals(forecasts.where(past), sales, keys)
    return error_metrics(pairs, []).select("mae", "mse", "rmse")


def coverage_metrics(pairs: DataFrame, by: Sequence[str] = KEYS, model: str | None = None) -> DataFrame:
    """Errors plus interval coverage per group.

    ``accuracy`` is the share of actuals strictly inside the interval, ``stocked`` the share
    strictly below its upper bound. A missing or NaN value on either side is a miss; ``n`` counts
    all pairs, and ``n_null`` those without a value or a forecast.
    """
    y, lower, upper = F.col("y"), F.col("yhat_lower"), F.col("yhat_upper")
    scored = usable(y).isNotNull() & usable(F.col("yhat")).isNotNull()
    out = pairs.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(~scored).alias("n_null"),
        *_errors(),
        F.avg(inside_interval(y, lower, upper)).alias("accuracy"),
        F.avg(below_upper(y, upper)).alias("stocked"),
    )
    return out if model is None else out.withColumn("model", F.lit(model))


def coverage_overall(pairs: DataFrame) -> DataFrame:
    return coverage_metrics(pairs, []).select("accuracy", "stocked")


def compare_strategies(overview: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Errors of both strategies per series from one pass over the overview."""
    stacked = overview.select(
        *keys, "y", F.expr(f"stack(2, '{PER_SERIES}', yhat, '{TOP_DOWN}', yhat_agg) AS (model, yhat)")
    )
    return error_metrics(stacked, [*keys, "model"])


def champion(metrics: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Model with the smallest rmse per series, the first by name on a tie; NULL if none was scored."""
    rank = F.when(F.col("rmse").isNotNull(), F.struct("rmse", "model"))
    return metrics.groupBy(*keys).agg(F.min_by("model", rank).alias("model"), F.min("rmse").alias("rmse"))


def strategy_wins(metrics: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return champion(metrics, keys).groupBy("model").agg(F.count("*").alias("n_series"))


def pooled_miss(overview: DataFrame, by: Sequence[str]) -> DataFrame:
    """Misses of both strategies added up over the horizon, so that days may offset each other."""
    return overview.groupBy(*by).agg(F.sum("miss").alias("miss"), F.sum("agg_miss").alias("agg_miss"))


def _stacked(overview: DataFrame, keys: Sequence[str]) -> DataFrame:
    strategies = F.expr(f"stack(2, '{PER_SERIES}', yhat, '{TOP_DOWN}', yhat_agg) AS (model, yhat)")
    return overview.select(*keys, "date", "y", strategies)


def champions_at(overview: DataFrame, dates: Sequence[dt.date | str], keys: Sequence[str] = KEYS) -> DataFrame:
    """training_date, keys, model, rmse: the better strategy of each series, by all scores known on each of ``dates``.

    ``overview`` holds stored forecasts of earlier training dates with their actuals. A score is known
    once its day is over, so that no date sees an actual of its own future. A row counts at every
    date behind it, before anything is shuffled.
    """
    days = F.array(*[F.lit(as_date(d)) for d in sorted({as_date(d) for d in dates})])
    known = _stacked(overview, keys).withColumn("training_date", F.explode(F.filter(days, lambda d: d >= F.col("date"))))
    return champion(error_metrics(known, ["training_date", *keys, "model"]), ["training_date", *keys])


def route(direct: DataFrame, top_down: DataFrame, champions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """training_date, keys, ds, yhat, model: each series from its champion, once; without a score the direct forecast."""
    group = ["training_date", *keys]
    chosen = champions.select(*group, F.col("model").alias("champion"))
    columns = [*group, "ds", "yhat"]
    own = direct.select(*columns).join(chosen, group, "left").where(F.coalesce("champion", F.lit(PER_SERIES)) == PER_SERIES)
    split = top_down.select(*columns).join(chosen.where(F.col("champion") == TOP_DOWN), group)
    return own.select(*columns, F.lit(PER_SERIES).alias("model")).unionByName(split.select(*columns, F.lit(TOP_DOWN).alias("model")))
