"""Closed-form seasonal forecast of every series in one job, on built-in functions only.

A series is the rows that share the key columns. Its model is a linear trend times a weekday index
times a month index, with a normal interval around it. Fitting costs one shuffle by the key: every
later step needs the same grouping, so it runs on the rows where they are. The result is one short
row per series (the fitted model), and the forecast unfolds that row without any join. Plain SQL
expressions state the steps, since each ``Column`` call is a round trip to the JVM.

Rows of one series and day are added up before anything is grouped by series, with partial sums
before the shuffle. A series therefore reaches its task as one row per calendar day at most,
however many raw rows it had.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from seriesmill.functions.dates import as_date, horizon

KEYS = ("store", "item")
DAY_ZERO = dt.date(1995, 1, 1)  # day number 0 of the trend
TREND_FLOOR = 0.01  # smallest trend as a share of the series' mean, for lines that fall below zero
INDEX_FLOOR = 0.001  # smallest weekday index, keeps the month indices finite
WEEKDAYS = range(1, 8)
MONTHS = range(1, 13)


@dataclass(frozen=True)
class ForecastSpec:
    """Settings of a forecast.

    ``origin="series"`` starts the horizon after each series' own last day, ``origin="cutoff"``
    after the training cutoff, which then has to be given.
    """

    h: int = 30
    level: float = 0.95
    weekly: bool = True
    yearly: bool = True
    mode: str = "multiplicative"
    origin: str = "series"
    include_history: bool = False

    def __post_init__(self) -> None:
        if self.h < 1:
            raise ValueError("h must be at least one day")
        if not 0.0 < self.level < 1.0:
            raise ValueError("level must lie between 0 and 1")
        if self.mode != "multiplicative":
            raise ValueError("seasonality is multiplicative")
        if self.origin not in ("series", "cutoff"):
            raise ValueError("origin is 'series' or 'cutoff'")

    @property
    def z(self) -> float:
        return NormalDist().inv_cdf((1.0 + self.level) / 2.0)


def observations(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, ds, y): the day's total of each series; rows without a day or a value are dropped."""
    keep = F.col("date").isNotNull() & F.col("sales").isNotNull()
    if isinstance(sales.schema["sales"].dataType, (FloatType, DoubleType)):
        keep = keep & ~F.isnan("sales")
    return (
        sales.where(keep)
        .groupBy(*keys, F.col("date").alias("ds"))
        .agg(F.sum("sales").alias("y"))
    )


def task_count(spark: SparkSession) -> int:
    """Partitions for rows that are few but costly.

    Given as a number, it keeps adaptive execution from merging partitions that only look small:
    it weighs the rows as shuffled, not the work that follows.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _distinct_dates(cutoffs: Sequence[dt.date | str]) -> list[dt.date]:
    dates = sorted({as_date(c) for c in cutoffs})
    if not dates:
        raise ValueError("at least one cutoff is needed")
    return dates


def up_to_cutoffs(
    obs: DataFrame,
    keys: Sequence[str],
    cutoffs: Sequence[dt.date | str],
    n_partitions: int | None = None,
) -> DataFrame:
    """Each observation once for every cutoff on or after its day, as column ``training_date``.

    The rows are spread by series before they are multiplied, so the shuffle moves them once and
    each (cutoff, series) stays in the task that already holds the series.
    """
    dates = _distinct_dates(cutoffs)
    days = F.array(*[F.lit(c) for c in dates])
    return (
        obs.where(F.col("ds") <= F.lit(dates[-1]))
        .repartition(n_partitions or task_count(obs.sparkSession), *keys)
        .withColumn("training_date", F.explode(F.filter(days, lambda c: c >= F.col("ds"))))
    )


def _trend_sql(ds: str) -> str:
    return f"greatest(intercept + slope * datediff({ds}, DATE '{DAY_ZERO}'), lowest)"


def _array_sql(prefix: str, members: range) -> str:
    return "array(" + ", ".join(f"coalesce({prefix}{m}, 1.0D)" for m in members) + ")"


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


# Windows run in day order: floating-point sums then come out the same on every run.
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _with_line(obs: DataFrame, keys: Sequence[str], frame: str, *more: str) -> DataFrame:
    """(keys, ds, y, slope, intercept, lowest, more): the least-squares line over each row's frame, and its floor."""
    over = f"OVER (PARTITION BY {', '.join(_quoted(keys))} ORDER BY ds {frame})"
    head = [*_quoted(keys), "ds", "y"]
    moments = {"mean_t": "avg(t)", "mean_y": "avg(y)", "var_t": "var_pop(t)", "covar": "covar_pop(y, t)"}
    names = [m.split(" AS ")[-1] for m in more]
    return (
        obs.selectExpr(*_quoted(keys), "ds", "CAST(y AS DOUBLE) AS y", f"CAST(datediff(ds, DATE '{DAY_ZERO}') AS DOUBLE) AS t")
        .selectExpr(*head, *[f"{e} {over} AS {name}" for name, e in moments.items()], *more)
        # A single day has no direction: its line is its mean.
        .selectExpr(*head, "mean_t", "mean_y", "CASE WHEN var_t > 0 THEN covar / var_t ELSE 0.0D END AS slope", *names)
        .selectExpr(*head, "slope", "mean_y - slope * mean_t AS intercept", f"{TREND_FLOOR}D * abs(mean_y) AS lowest", *names)
    )


def _with_lines_at(obs: DataFrame, keys: Sequence[str], cutoffs: Sequence[dt.date | str]) -> DataFrame:
    """(training_date, keys, ds, y, slope, intercept, lowest): each row once per cutoff on or after its day.

    The line at a cutoff is the running line at the last day before it, so one sorted pass over the
    series yields all lines. They are handed to every row of the series as a short array, and only
    then do the rows multiply: what is shuffled and sorted does not grow with the cutoffs.
    """
    by = ", ".join(_quoted(keys))
    dates = _distinct_dates(cutoffs)
    days = "array(" + ", ".join(f"DATE '{d}'" for d in dates) + ")"
    spread = obs.where(F.col("ds") <= F.lit(dates[-1])).repartition(task_count(obs.sparkSession), *keys)
    running = _with_line(spread, keys, SO_FAR, f"lead(ds) OVER (PARTITION BY {by} ORDER BY ds) AS next_ds")
    mine = f"filter({days}, c -> c >= ds AND (next_ds IS NULL OR c < next_ds))"
    line = "named_struct('training_date', c, 'slope', slope, 'intercept', intercept, 'lowest', lowest)"
    return (
        running.selectExpr(*_quoted(keys), "ds", "y", f"transform({mine}, c -> {line}) AS lines")
        .selectExpr(
            *_quoted(keys), "ds", "y",
            f"collect_list(CASE WHEN size(lines) > 0 THEN lines END) OVER (PARTITION BY {by} ORDER BY ds {WHOLE}) AS lines",
        )
        .selectExpr(*_quoted(keys), "ds", "y", "inline(filter(flatten(lines), l -> l.training_date >= ds))")
    )


def fit(
    sales: DataFrame,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = ForecastSpec(),
    cutoffs: Sequence[dt.date | str] | None = None,
) -> DataFrame:
    """One row per series (and per cutoff, if cutoffs are given) that holds the fitted model.

    Columns: keys, n, first_ds, last_ds, intercept, slope, lowest (floor of the trend), sd, weekly array of 7 from Sunday,
    yearly array of 12, and with ``include_history`` the days seen.
    """
    obs = observations(sales, keys)
    if cutoffs is None:
        group, rows = list(keys), _with_line(obs, keys, WHOLE)
    else:
        group, rows = ["training_date", *keys], _with_lines_at(obs, keys, cutoffs)
    rows = rows.selectExpr(*_quoted(group), "ds", "y", "slope", "intercept", "lowest", f"{_trend_sql('ds')} AS trend")

    # Given the trend, a factor is the same for all days of one month and weekday. The moments of these
    # cells, 84 at most per series, therefore hold all that the indices and the residuals need.
    cells = rows.groupBy(*group, F.month("ds").alias("month"), F.dayofweek("ds").alias("weekday")).agg(
        *[
            F.expr(e)
            for e in (
                "count(*) AS n", "min(ds) AS first_ds", "max(ds) AS last_ds",
                "max(slope) AS slope", "max(intercept) AS intercept", "max(lowest) AS lowest",
                "avg(y) AS mean_y", "avg(trend) AS mean_trend",
                "var_pop(y) AS var_y", "var_pop(trend) AS var_trend", "covar_pop(y, trend) AS covar",
            )
        ],
        *([F.collect_list("ds").alias("history")] if spec.include_history else []),
    )
    return model_of_cells(cells, group, spec)


def model_of_cells(cells: DataFrame, group: Sequence[str], spec: ForecastSpec) -> DataFrame:
    """One row per ``group`` with the fitted model, from the moments of its (month, weekday) cells."""
    head = _quoted(group)
    groups = ", ".join(head)
    same_weekday = f"(PARTITION BY {groups}, weekday ORDER BY month {WHOLE})"
    same_month = f"(PARTITION BY {groups}, month ORDER BY weekday {WHOLE})"
    # Ratios of sums, not means of ratios: days on which the line is close to zero do not rule the index.
    weekly = f"greatest(coalesce(sum(n * mean_y) OVER {same_weekday} / nullif(sum(n * mean_trend) OVER {same_weekday}, 0), 1.0D), {INDEX_FLOOR}D)"
    yearly = f"coalesce(sum(n * mean_y) OVER {same_month} / nullif(sum(n * mean_trend * w) OVER {same_month}, 0), 1.0D)"
    cells = (
        cells.selectExpr("*", f"{weekly if spec.weekly else '1.0D'} AS w")
        .selectExpr("*", f"{yearly if spec.yearly else '1.0D'} AS m")
        .selectExpr(
            "*",
            "mean_y - w * m * mean_trend AS residual",
            "greatest(var_y - 2 * w * m * covar + w * m * w * m * var_trend, 0.0D) AS var_residual",
        )
    )
    sums = [
        "sum(n) AS n", "min(first_ds) AS first_ds", "max(last_ds) AS last_ds",
        "max(intercept) AS intercept", "max(slope) AS slope", "max(lowest) AS lowest",
        "sum(n * var_residual) AS within", "sum(n * residual * residual) AS square", "sum(n * residual) AS total",
        *[f"max(CASE WHEN weekday = {d} THEN w END) AS w{d}" for d in WEEKDAYS],
        *[f"max(CASE WHEN month = {k} THEN m END) AS m{k}" for k in MONTHS],
        *(["array_sort(flatten(collect_list(history))) AS history"] if spec.include_history else []),
    ]
    # A weekday or month without observations has no index of its own and counts as neutral.
    return (
        cells.groupBy(*group)
        .agg(*[F.expr(e) for e in sums])
        .selectExpr(
            *head, "n", "first_ds", "last_ds", "intercept", "slope", "lowest",
            "sqrt(greatest(within + square - total * total / n, 0.0D) / nullif(n - 1, 0)) AS sd",
            _array_sql("w", WEEKDAYS) + " AS weekly",
            _array_sql("m", MONTHS) + " AS yearly",
            *(["history"] if spec.include_history else []),
        )
    )


def predict(model: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Unfold fitted models into one row per day: parts, point forecast and interval."""
    group = [c for c in model.columns if c not in _MODEL_COLUMNS]
    if spec.origin == "cutoff" and "training_date" not in group:
        raise ValueError("origin='cutoff' needs cutoffs")
    days = horizon(F.col("training_date" if spec.origin == "cutoff" else "last_ds"), spec.h)
    if spec.include_history:
        days = F.concat("history", days)
    names = _quoted(group)
    return (
        model.select(*group, "intercept", "slope", "lowest", "sd", "weekly", "yearly", F.explode(days).alias("ds"))
        .selectExpr(
            *names, "ds",
            f"{_trend_sql('ds')} AS trend",
            "element_at(weekly, dayofweek(ds)) AS weekly",
            "element_at(yearly, month(ds)) AS yearly",
            f"{spec.z!r}D * sd AS margin",
        )
        .selectExpr(*names, "ds", "trend", "weekly", "yearly", "trend * weekly * yearly AS yhat", "margin")
        .selectExpr(
            *names, "ds", "trend", "weekly", "yearly", "yhat",
            "yhat - margin AS yhat_lower",
            "yhat + margin AS yhat_upper",
        )
    )


_MODEL_COLUMNS = {
    "n", "first_ds", "last_ds", "intercept", "slope", "lowest", "sd", "weekly", "yearly", "history",
}


def _predicted(sales, keys, spec, where, cutoffs, without: Sequence[str]) -> DataFrame:
    """Keys go by neutral names in between, so that one may be called like a column of the model."""
    chosen = sales if where is None else sales.where(where)
    inner = [f"_key{n}" for n in range(len(keys))]
    named = chosen.select("date", "sales", *[F.col(f"`{k}`").alias(i) for k, i in zip(keys, inner)])
    return predict(fit(named, inner, spec, cutoffs), spec).drop(*without).withColumnsRenamed(dict(zip(inner, keys)))


def forecast(
    sales: DataFrame,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = ForecastSpec(),
    where: str | None = None,
    cutoffs: Sequence[dt.date | str] | None = None,
) -> DataFrame:
    """Forecast every series: (training_date if cutoffs,) keys, ds, yhat, yhat_lower, yhat_upper.

    ``where`` chooses series before they are grouped, so that it can reach the scan. With
    ``keys=["item"]`` the stores of an item are added up first.
    """
    return _predicted(sales, keys, spec, where, cutoffs, ("trend", "weekly", "yearly"))


def forecast_components(
    sales: DataFrame,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = ForecastSpec(),
    where: str | None = None,
    cutoffs: Sequence[dt.date | str] | None = None,
) -> DataFrame:
    """The parts of each forecast value: keys, ds, trend, weekly, yearly, yhat."""
    return _predicted(sales, keys, spec, where, cutoffs, ("yhat_lower", "yhat_upper"))
