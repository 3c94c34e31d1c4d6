"""Daily retraining at a cost that does not grow with the history, and repair of what late corrections made stale.

The moments of every series are stored as one partition per arrival version. A delivery reads the
partition before it and its own rows, writes the next one, and forecasts from it. Sales are read back
only for days that had been delivered before, and for series where the floor of the trend binds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.operators.forecast import KEYS, ForecastSpec, fit, observations, predict
from seriesmill.operators.moments import cell_moments, day_moments, fit_moments, merge_moments, moments_at
from seriesmill.plans.walk_forward import NEXT_DAY, store_forecasts, walk_forward
from seriesmill.sources.tables import VERSION, exists, history, materialise, newest_version, read_table, save_partition, snapshot


def seed_moments(sales: DataFrame, target: str, version: int = 0, keys: Sequence[str] = KEYS) -> None:
    """Store the moments of all sales known at a version."""
    save_partition(cell_moments(sales, keys).withColumn(VERSION, F.lit(version).cast("bigint")), target, VERSION)


def read_moments(spark: SparkSession, target: str, version: int) -> DataFrame | None:
    """The moments stored for a version, None if there are none."""
    if not exists(spark, target):
        return None
    state = read_table(spark, target).where(F.col(VERSION) == version).drop(VERSION)
    return None if state.isEmpty() else state


def totals_of(sales: DataFrame, obs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Daily totals in ``sales`` of the series and days of ``obs``; the dates reach the scan as a range."""
    first, last = obs.agg(F.min("ds"), F.max("ds")).first()
    if first is None:
        return observations(sales, keys).limit(0)
    inside = sales.where((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(last)))
    return observations(inside, keys).join(obs.select(*keys, "ds"), [*keys, "ds"], "left_semi")


def corrected_moments(state: DataFrame, before: DataFrame, after: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``state`` with the daily totals ``before`` taken out and ``after`` put in."""
    out = day_moments(before, keys, -1).withColumns({c: F.lit(None).cast("date") for c in ("first_ds", "last_ds")}).drop("ds")
    put = day_moments(after, keys).withColumns({c: F.col("ds") for c in ("first_ds", "last_ds")}).drop("ds")
    return merge_moments(state.unionByName(out).unionByName(put), keys)


def advance_moments(state: DataFrame | None, fresh: DataFrame, target: str, version: int, keys: Sequence[str] = KEYS) -> None:
    """Store the moments of ``version``: ``state`` plus the daily totals ``fresh``. A second call writes the same partition."""
    days = day_moments(fresh, keys).withColumns({c: F.col("ds") for c in ("first_ds", "last_ds")}).drop("ds")
    moments = merge_moments(days if state is None else state.unionByName(days), keys)
    save_partition(moments.withColumn(VERSION, F.lit(version).cast("bigint")), target, VERSION)


def forecast_at(
    state: DataFrame | None,
    fresh: DataFrame,
    cutoffs: Sequence[dt.date | str],
    rows: Callable[[], DataFrame],
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = NEXT_DAY,
) -> DataFrame:
    """The forecasts of ``walk_forward`` at cutoffs that all lie behind the days of ``state``.

    ``fresh`` are the daily totals since. ``rows`` yields all sales, and is asked only if the
    floor of the trend binds; then only those series are read from it.
    """
    inner = [f"_key{n}" for n in range(len(keys))]
    names = dict(zip(keys, inner))
    group = ["training_date", *inner]
    days = day_moments(fresh.withColumnsRenamed(names), inner)
    moments = moments_at(None if state is None else state.withColumnsRenamed(names), days, cutoffs, inner)

    def from_rows(bound: DataFrame) -> DataFrame:
        named = rows().select("date", "sales", *[F.col(f"`{k}`").alias(i) for k, i in names.items()])
        own = named.join(bound.select(*inner).distinct(), inner, "left_semi")
        return fit(own, inner, spec, cutoffs).join(bound, group, "left_semi")

    return predict(fit_moments(moments, group, spec, from_rows), spec).drop("trend", "weekly", "yearly").withColumnsRenamed({i: k for k, i in names.items()})


def record_training(spark: SparkSession, dates: Sequence[dt.date], version: int, target: str) -> None:
    """Note which version of the sales the stored forecasts of each training date know."""
    rows = spark.createDataFrame([(d, version) for d in sorted(set(dates))], "training_date DATE, data_version BIGINT")
    save_partition(rows, target, "training_date")


def stale_dates(trained: DataFrame, arrivals: DataFrame) -> DataFrame:
    """training_date of every run that a later version has changed a day of.

    ``trained`` has training_date and data_version, ``arrivals`` arrival_version and min_date, the
    first day that a version brought (``history``). A run is stale if some version that it did not
    know holds a day up to its training date: the smallest min_date of all later versions decides.
    """
    runs = trained.select(F.col("data_version").alias("version"), "training_date", F.lit(None).cast("date").alias("min_date"))
    brought = arrivals.select(F.col(VERSION).alias("version"), F.lit(None).cast("date").alias("training_date"), "min_date")
    later = Window.orderBy("version").rangeBetween(1, Window.unboundedFollowing)  # a row per run and version
    seen = runs.unionByName(brought).withColumn("earliest", F.min("min_date").over(later))
    return seen.where("earliest <= training_date").select("training_date")


def refresh_stale(
    sales: DataFrame,
    corrected: DataFrame,
    dates: Sequence[dt.date],
    forecasts: str,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = NEXT_DAY,
) -> None:
    """Forecast again, in one job, the ``corrected`` series at all stale training dates.

    Other series keep their stored rows: nothing of theirs has changed.
    """
    if not dates:
        return
    spark = sales.sparkSession
    series = corrected.select(*keys).distinct()
    again = walk_forward(sales.join(series, list(keys), "left_semi"), dates, keys, spec)
    stored = read_table(spark, forecasts).where(F.col("training_date").isin(list(dates)))
    kept = stored.join(series, list(keys), "left_anti").select(again.columns)
    # Written elsewhere first: the partitions that are read are the ones to be replaced.
    store_forecasts(materialise(again.unionByName(kept), "refreshed"), forecasts)


def train_on_version(
    spark: SparkSession,
    table: str,
    version: int,
    forecasts: str,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = NEXT_DAY,
) -> None:
    """Forecast from every day that a version of the growing table brought, and mend what it corrected.

    New days are forecast from the moments of the version before, which are read back from
    ``<forecasts>_moments`` (or made once, from all earlier sales), and the day's own rows. A day that is not
    new changes the moments by its totals before and after; the runs that had seen it, or come after
    it, are forecast again for its series. Which runs know which version is noted in ``<forecasts>_runs``.
    """
    moments, runs = f"{forecasts.rstrip('/')}_moments", f"{forecasts.rstrip('/')}_runs"
    landed = newest_version(read_table(spark, table).where(F.col(VERSION) == version))
    obs = materialise(observations(landed, keys), "delivery")
    state = read_moments(spark, moments, version - 1)
    if state is None and version > 0:
        earlier = snapshot(read_table(spark, table), version - 1)
        seed_moments(earlier, moments, version - 1, keys)
        state = read_moments(spark, moments, version - 1)
    frontier = None if state is None else state.agg(F.max("last_ds")).first()[0]
    days = sorted(r[0] for r in obs.select("ds").distinct().collect())  # the days of one delivery
    new = [d for d in days if frontier is None or d > frontier]
    old = [d for d in days if d not in new]

    def sales() -> DataFrame:
        return snapshot(read_table(spark, table), version).drop(VERSION)

    if old:
        late = obs.where(F.col("ds") <= F.lit(frontier))
        before = totals_of(snapshot(read_table(spark, table), version - 1), late, keys)
        state = materialise(corrected_moments(state, before, totals_of(sales(), late, keys), keys), "corrected-moments")
    fresh = obs if frontier is None else obs.where(F.col("ds") > F.lit(frontier))
    if new:
        store_forecasts(forecast_at(state, fresh, new, sales, keys, spec), forecasts)
    if old:
        trained = read_table(spark, runs) if exists(spark, runs) else None
        known = set() if trained is None else {r[0] for r in trained.select("training_date").where(F.col("training_date").isin(old)).collect()}
        missing = [d for d in old if d not in known]
        stale = [] if trained is None else sorted(r[0] for r in stale_dates(trained, history(read_table(spark, table).where(F.col(VERSION) <= version))).collect())
        if missing:
            store_forecasts(walk_forward(sales(), missing, keys, spec), forecasts)
        refresh_stale(sales(), late, stale, forecasts, keys, spec)
        new = [*new, *missing, *stale]
    if new:
        record_training(spark, new, version, runs)
    advance_moments(state, fresh, moments, version, keys)
