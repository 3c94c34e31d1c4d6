"""Bottom-up against top-down, from sales to the comparison, as one lazy plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.allocate import allocate, shares_at, store_share
from seriesmill.operators.evaluate import prediction_overview, with_actuals
from seriesmill.operators.forecast import ForecastSpec, forecast
from seriesmill.plans.walk_forward import NEXT_DAY, walk_forward


def allocated_forecast(train: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Forecast every item on its total over the stores, then split it by store share."""
    return allocate(forecast(train, ["item"], spec), store_share(train))


def strategy_overview(train: DataFrame, test: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Actuals of the hold-out next to both strategies' forecasts.

    Nothing is written in between, so that the unmatched rows of the allocation are pruned by the
    inner joins and the training sales are shuffled once for all branches.
    """
    return prediction_overview(test, forecast(train, spec=spec), allocated_forecast(train, spec))


def allocated_walk_forward(sales: DataFrame, cutoffs: Sequence[dt.date | str], spec: ForecastSpec = NEXT_DAY) -> DataFrame:
    """training_date, store, item, ds, yhat: at each cutoff, item forecasts split by the shares known there."""
    items = walk_forward(sales, cutoffs, ["item"], spec).select("training_date", "item", "ds", "yhat")
    shares = shares_at(sales, cutoffs).select("training_date", "item", "store", "ratio")
    return items.join(shares, ["training_date", "item"]).select("training_date", "store", "item", "ds", (F.col("yhat") * F.col("ratio")).alias("yhat"))


def walk_forward_overview(sales: DataFrame, cutoffs: Sequence[dt.date | str], spec: ForecastSpec = NEXT_DAY) -> DataFrame:
    """training_date, date, store, item, y, yhat, yhat_agg: both strategies at every cutoff, where the actual is known."""
    key = ["training_date", "store", "item", "ds"]
    top_down = allocated_walk_forward(sales, cutoffs, spec).withColumnRenamed("yhat", "yhat_agg")
    both = walk_forward(sales, cutoffs, spec=spec).select(*key, "yhat").join(top_down, key)
    scored = with_actuals(both, sales)
    return scored.select("training_date", F.col("ds").alias("date"), "store", "item", F.col("y").cast("double").alias("y"), "yhat", "yhat_agg")
