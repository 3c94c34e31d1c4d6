"""Fitting from stored moments instead of rows.

The trend of a series is a straight line in the day number, so that all that the closed form needs of
a (month, weekday) cell are sums of t, t², y, y² and t·y. Sums can be added: a new day is added to its
cell, a corrected one is taken out and put in again, and days without a sale are counted from the
calendar. Whole-numbered sales have exact sums, however often they are merged.

Only where the floor of the trend binds are rows needed, since the trend is no line there; those
series, and no others, are fitted from rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from seriesmill.functions.dates import as_date
from seriesmill.operators.forecast import DAY_ZERO, KEYS, TREND_FLOOR, WHOLE, ForecastSpec, fit, model_of_cells, observations, predict
from seriesmill.sources.tables import materialise

CELL = ("month", "weekday")
SUMS = ("n", "s_t", "s_tt", "s_y", "s_yy", "s_ty")
_T = f"CAST(datediff(ds, DATE '{DAY_ZERO}') AS BIGINT)"


def day_moments(obs: DataFrame, keys: Sequence[str] = KEYS, sign: int = 1) -> DataFrame:
    """(keys, ds, month, weekday, sums) of daily totals (keys, ds, y); ``sign=-1`` takes them out again."""
    real = isinstance(obs.schema["y"].dataType, (FloatType, DoubleType))
    y = "CAST(y AS DOUBLE)" if real else "CAST(y AS DECIMAL(18, 0))"
    wide = "DOUBLE" if real else "DECIMAL(38, 0)"
    sums = {"n": "1L", "s_t": _T, "s_tt": f"{_T} * {_T}"}
    sums |= {"s_y": f"CAST({y} AS {wide})", "s_yy": f"CAST({y} * {y} AS {wide})", "s_ty": f"CAST({y} * {_T} AS {wide})"}
    return obs.select(
        *keys, "ds", F.expr("month(ds)").alias("month"), F.expr("dayofweek(ds)").alias("weekday"),
        *[F.expr(e if sign > 0 else f"-({e})").alias(name) for name, e in sums.items()],
    )


def merge_moments(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add up moments by ``keys`` and cell; a cell without days is left out."""
    kinds = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in SUMS]
    added = parts.groupBy(*keys, *CELL).agg(*sums, F.min("first_ds").alias("first_ds"), F.max("last_ds").alias("last_ds"))
    return added.where("n > 0")


def _with_days(moments: DataFrame) -> DataFrame:
    return moments.withColumns({"first_ds": F.col("ds"), "last_ds": F.col("ds")}).drop("ds")


def cell_moments(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, month, weekday, sums, first_ds, last_ds) of all sales: 84 rows per series at most."""
    return merge_moments(_with_days(day_moments(observations(sales, keys), keys)), keys)


def moments_at(state: DataFrame | None, days: DataFrame, cutoffs: Sequence[dt.date | str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Moments as of each cutoff, as column ``training_date``: the state before plus the ``day_moments`` up to it.

    All days of ``state`` must lie before the first cutoff.
    """
    dates = F.array(*[F.lit(as_date(c)) for c in sorted({as_date(c) for c in cutoffs})])
    rows = _with_days(days.withColumn("training_date", F.explode(F.filter(dates, lambda c: c >= F.col("ds")))))
    if state is not None:
        rows = rows.unionByName(state.select(*keys, *CELL, *SUMS, "first_ds", "last_ds", F.explode(dates).alias("training_date")))
    return merge_moments(rows, ["training_date", *keys])


def _month_days(start: str, k: str, weekday: str) -> dict[str, str]:
    """Number, sum and sum of squares of the day numbers of a weekday among the first ``k`` days of a month."""
    offset = f"pmod({weekday} - dayofweek({start}), 7)"
    n = f"CAST(CASE WHEN {k} > {offset} THEN ({k} - {offset} - 1) DIV 7 + 1 ELSE 0 END AS BIGINT)"
    t = f"CAST(datediff({start}, DATE '{DAY_ZERO}') + {offset} AS BIGINT)"
    return {
        "n": n,
        "s_t": f"({n} * {t} + 7 * ({n} * ({n} - 1) DIV 2))",
        "s_tt": f"({n} * {t} * {t} + 7 * {t} * {n} * ({n} - 1) + 49 * (({n} - 1) * {n} * (2 * {n} - 1) DIV 6))",
    }


def calendar_before(months: DataFrame) -> DataFrame:
    """month_start, before: for each of the consecutive ``months``, the days of all 84 cells in the months before it.

    ``before`` is an array by (month - 1) * 7 + weekday - 1 of their number and the sums of t and t².
    """
    cells = months.select("month_start", F.explode(F.sequence(F.lit(0), F.lit(83))).alias("cell"))
    full = _month_days("month_start", "day(last_day(month_start))", "(cell % 7 + 1)")
    own = {c: f"CASE WHEN month(month_start) = cell DIV 7 + 1 THEN {e} ELSE 0L END" for c, e in full.items()}
    earlier = "OVER (PARTITION BY cell ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sums = cells.selectExpr("month_start", "cell", *[f"{e} AS {c}" for c, e in own.items()])
    sums = sums.selectExpr("month_start", "cell", *[f"coalesce(sum({c}) {earlier}, 0L) AS {c}" for c in full])
    entries = F.array_sort(F.collect_list(F.struct("cell", *full)))  # 84 of each month
    return sums.groupBy("month_start").agg(entries.alias("before"))


def zero_filled(moments: DataFrame, keys: Sequence[str] = KEYS, until: dt.date | str | None = None) -> DataFrame:
    """Moments as if every day without a sale, from the first sale of a series to its last, had sold 0.

    ``until`` fills up to that day instead of the last sale; later sales must not be in ``moments``.
    Zeros change the number of days and the sums of t and t² only, and those follow from the calendar: the
    days of a cell up to the end, less those before the start, each a prefix count of whole months and
    a part of one. No row per day is made.
    """
    ends = F.max("last_ds") if until is None else F.lit(as_date(until))
    ranges = moments.groupBy(*keys).agg(F.min("first_ds").alias("first_ds"), ends.alias("last_ds"))
    span = ranges.agg(F.min("first_ds").alias("a"), F.max("last_ds").alias("z")).where("a IS NOT NULL")
    months = span.select(F.explode(F.expr("sequence(trunc(a, 'MM'), trunc(z, 'MM'), INTERVAL 1 MONTH)")).alias("month_start"))
    before = calendar_before(months)
    start, end = (before.select(F.col("month_start").alias(f"{x}_month"), F.col("before").alias(f"{x}_before")) for x in ("first", "last"))
    placed = ranges.withColumns({"first_month": F.expr("trunc(first_ds, 'MM')"), "last_month": F.expr("trunc(last_ds, 'MM')")})
    placed = placed.join(start, "first_month").join(end, "last_month").withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(83))))
    until_end = _month_days("last_month", "day(last_ds)", "(cell % 7 + 1)")
    until_start = _month_days("first_month", "(day(first_ds) - 1)", "(cell % 7 + 1)")

    def counted(c: str) -> str:
        whole = f"element_at(last_before, cell + 1).{c} - element_at(first_before, cell + 1).{c}"
        parts = f"CASE WHEN month(last_month) = cell DIV 7 + 1 THEN {until_end[c]} ELSE 0L END - CASE WHEN month(first_month) = cell DIV 7 + 1 THEN {until_start[c]} ELSE 0L END"
        return f"{whole} + {parts} AS {c}"

    names = [f"`{k}`" for k in keys]
    days = placed.selectExpr(*names, "cell DIV 7 + 1 AS month", "cell % 7 + 1 AS weekday", "first_ds", "last_ds", *[counted(c) for c in ("n", "s_t", "s_tt")]).where("n > 0")
    days = days.withColumns({"month": F.col("month").cast("int"), "weekday": F.col("weekday").cast("int")})
    kinds = {f.name: f.dataType.simpleString() for f in moments.schema.fields}
    sold = [F.coalesce(c, F.lit(0)).cast(kinds[c]).alias(c) for c in ("s_y", "s_yy", "s_ty")]
    found = moments.select(*keys, *CELL, "s_y", "s_yy", "s_ty")
    return days.join(found, [*keys, *CELL], "left").select(*keys, *CELL, "n", "s_t", "s_tt", *sold, "first_ds", "last_ds")


def zero_filled_rows(sales: DataFrame, keys: Sequence[str] = KEYS, until: dt.date | str | None = None) -> DataFrame:
    """(keys, date, sales) with a 0 for every day without a sale: the long way, for the few series that need rows."""
    obs = observations(sales, keys)
    ends = F.max("ds") if until is None else F.lit(as_date(until))
    grid = obs.groupBy(*keys).agg(F.min("ds").alias("a"), ends.alias("z")).select(*keys, F.explode(F.sequence("a", "z")).alias("ds"))
    return grid.join(obs, [*keys, "ds"], "left").select(*keys, F.col("ds").alias("date"), F.coalesce("y", F.lit(0)).alias("sales"))


def _cells(moments: DataFrame, group: Sequence[str]) -> DataFrame:
    """Cells as ``model_of_cells`` takes them, and ``bound``: whether the floor of the trend binds on a day of the series."""
    head = [f"`{g}`" for g in group]
    over = f"OVER (PARTITION BY {', '.join(head)} ORDER BY month, weekday {WHOLE})"
    totals = [f"sum({c}) {over} AS all_{c}" for c in ("n", "s_t", "s_tt", "s_y", "s_ty")]
    days = [f"min(first_ds) {over} AS line_first", f"max(last_ds) {over} AS line_last"]

    def number(c: str) -> str:
        return f"CAST({c} AS DOUBLE)"

    exact = "DOUBLE" if isinstance(moments.schema["s_y"].dataType, DoubleType) else "DECIMAL(38, 0)"

    def times(a: str, b: str) -> str:
        return f"CAST(CAST({a} AS {exact}) * CAST({b} AS {exact}) AS {exact})"

    # Differences of products are taken before they are rounded to a double.
    spread, joint = f"({times('all_n', 'all_s_tt')} - {times('all_s_t', 'all_s_t')})", f"({times('all_n', 'all_s_ty')} - {times('all_s_t', 'all_s_y')})"
    lined = (
        moments.selectExpr("*", *totals, *days)
        .selectExpr("*", f"CASE WHEN {spread} > 0 THEN {number(joint)} / {number(spread)} ELSE 0.0D END AS slope", f"{number('all_s_y')} / all_n AS all_mean")
        .selectExpr("*", "all_mean - slope * (CAST(all_s_t AS DOUBLE) / all_n) AS intercept", f"{TREND_FLOOR}D * abs(all_mean) AS lowest")
    )

    def at(day: str) -> str:
        return f"intercept + slope * datediff({day}, DATE '{DAY_ZERO}')"

    def variance(a: str, b: str, ab: str) -> str:
        return f"{number(f'({times("n", ab)} - {times(a, b)})')} / (CAST(n AS DOUBLE) * n)"

    return lined.selectExpr(
        *head, *CELL, "n", "first_ds", "last_ds", "slope", "intercept", "lowest",
        f"least({at('line_first')}, {at('line_last')}) < lowest AS bound",
        f"{number('s_y')} / n AS mean_y",
        "intercept + slope * (CAST(s_t AS DOUBLE) / n) AS mean_trend",
        f"{variance('s_y', 's_y', 's_yy')} AS var_y",
        f"slope * slope * {variance('s_t', 's_t', 's_tt')} AS var_trend",
        f"slope * {variance('s_t', 's_y', 's_ty')} AS covar",
    )


def fit_moments(
    moments: DataFrame,
    group: Sequence[str],
    spec: ForecastSpec,
    rows: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The models of ``fit``, one row per ``group``, from moments.

    ``rows`` is asked only if the floor of the trend binds somewhere: it gets those groups and
    returns their models, fitted from rows.
    """
    if spec.include_history:
        raise ValueError("moments do not hold the days seen")
    cells = materialise(_cells(moments, group), "cells")
    models = model_of_cells(cells.where("NOT bound"), group, spec)
    bound = cells.where("bound").select(*group).distinct()
    return models if bound.isEmpty() else models.unionByName(rows(bound))


def moment_forecast(
    sales: DataFrame,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = ForecastSpec(),
    zero_fill: bool = False,
    until: dt.date | str | None = None,
) -> DataFrame:
    """``forecast`` by way of moments: keys, ds, yhat, yhat_lower, yhat_upper.

    With ``zero_fill`` days without a sale count as 0 (``zero_filled``); without it the result is that of ``forecast``.
    """
    inner = [f"_key{n}" for n in range(len(keys))]
    named = sales.select("date", "sales", *[F.col(f"`{k}`").alias(i) for k, i in zip(keys, inner)])
    if until is not None:
        named = named.where(F.col("date") <= F.lit(as_date(until)))
    moments = cell_moments(named, inner)
    if zero_fill:
        moments = zero_filled(materialise(moments, "moments"), inner, until)

    def from_rows(bound: DataFrame) -> DataFrame:
        own = named.join(bound, inner, "left_semi")
        return fit(zero_filled_rows(own, inner, until) if zero_fill else own, inner, spec)

    model = fit_moments(moments, inner, spec, from_rows)
    return predict(model, spec).drop("trend", "weekly", "yearly").withColumnsRenamed(dict(zip(inner, keys)))
