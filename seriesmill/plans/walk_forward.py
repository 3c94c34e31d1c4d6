"""Walk-forward evaluation with the cutoffs as data: one job, however many cutoffs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

import pyspark
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.functions.dates import as_date
from seriesmill.operators.forecast import KEYS, ForecastSpec, forecast
from seriesmill.sources.tables import VERSION, history, read_table, save_partition

NEXT_DAY = ForecastSpec(h=1, origin="cutoff")


def walk_forward(
    sales: DataFrame,
    cutoffs: Sequence[dt.date | str],
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = NEXT_DAY,
) -> DataFrame:
    """For each cutoff, the forecast from all sales up to it: training_date, keys, ds, yhat and bounds."""
    return forecast(sales, keys, spec, cutoffs=cutoffs)


def store_forecasts(forecasts: DataFrame, target: str) -> None:
    """Keep forecasts by training date. Training a date again replaces that date only."""
    save_partition(forecasts, target, "training_date")


def version_arrivals(sales: DataFrame, seeded_before: dt.date | str) -> DataFrame:
    """Number the arrivals of a growing table: 0 for the seed, then one version per day."""
    edge = F.lit(as_date(seeded_before))
    days = F.datediff("date", edge) + 1
    return sales.withColumn(VERSION, F.when(F.col("date") < edge, 0).otherwise(days).cast("bigint"))


def run_parameters(spec: ForecastSpec, keys: Sequence[str] = KEYS, model: str = "closed_form") -> dict[str, str]:
    """All that sets one run apart from another on the same data: every setting, the keys and the model."""
    return {
        "keys": ",".join(keys),
        "model": model,
        "weekly": str(spec.weekly),
        "yearly": str(spec.yearly),
        "include_history": str(spec.include_history),
        "library": f"pyspark {pyspark.__version__}",
        "h": str(spec.h),
        "level": str(spec.level),
        "mode": spec.mode,
        "origin": spec.origin,
    }


def ledger_rows(
    forecasts: DataFrame,
    grown: DataFrame,
    cutoffs: Sequence[dt.date | str],
    params: Mapping[str, str],
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """One run record per training date.

    Columns: run_id, training_date, data_version (the newest version that the run could see), params,
    n_series, n_rows. The run id is a digest of date, version and parameters, so the same run always
    has the same id.
    """
    days = sorted({as_date(c) for c in cutoffs})
    # Each version counts at the first cutoff that sees it; the newest so far is a running maximum.
    first_seen = F.element_at(F.filter(F.array(*map(F.lit, days)), lambda c: c >= F.col("min_date")), 1)
    seen = history(grown).where(F.col("min_date") <= F.lit(days[-1])).select(first_seen.alias("training_date"), VERSION)
    cutoff = grown.sparkSession.createDataFrame([(d, None) for d in days], f"training_date DATE, {VERSION} BIGINT")
    per_date = seen.union(cutoff).groupBy("training_date").agg(F.max(VERSION).alias("newest"))
    running = F.max("newest").over(Window.orderBy("training_date").rowsBetween(Window.unboundedPreceding, 0))  # a row per cutoff
    visible = per_date.select("training_date", running.alias("data_version"))
    # Series first, then dates: a distinct count per date would gather all series of a date in one task.
    sizes = (
        forecasts.groupBy("training_date", *keys)
        .agg(F.count("*").alias("n_rows"))
        .groupBy("training_date")
        .agg(F.count("*").alias("n_series"), F.sum("n_rows").alias("n_rows"))
    )
    pairs = [F.lit(part) for name in sorted(params) for part in (name, params[name])]
    text = "|".join(f"{name}={params[name]}" for name in sorted(params))
    run_id = F.sha2(F.concat_ws("|", F.col("training_date").cast("string"), F.col("data_version"), F.lit(text)), 256)
    return sizes.join(visible, "training_date", "left").select(
        run_id.alias("run_id"), "training_date", "data_version", F.create_map(*pairs).alias("params"), "n_series", "n_rows"
    )


def append_runs(rows: DataFrame, target: str) -> None:
    """Record runs; recording one again changes nothing."""
    save_partition(rows, target, "run_id")


def read_runs(spark: SparkSession, target: str) -> DataFrame:
    columns = ["run_id", "training_date", "data_version", "params", "n_series", "n_rows"]
    return read_table(spark, target).select(*columns)
