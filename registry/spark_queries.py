"""Every registered query: (spark, folder of the test tables) -> DataFrame.

Doubles are rounded to four places here, for the comparison with other engines; the library itself
never rounds.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.utils import AnalysisException

from seriesmill.functions.dates import date_range
from seriesmill.operators import calibrate, evaluate, explore, moments, periods, profiles, quality, representative
from seriesmill.operators.allocate import allocate, shares_at, store_share
from seriesmill.operators.forecast import ForecastSpec, forecast
from seriesmill.operators.forecast import forecast_components as components
from seriesmill.operators.grouped import grouped_forecast, closed_form_model, weekday_mean_model
from seriesmill.plans import layers, retrain, strategies, walk_forward
from seriesmill.plans.strategies import allocated_forecast as top_down_forecast
from seriesmill.plans.strategies import strategy_overview
from seriesmill.session import shared_folder
from seriesmill.sources import tables
from seriesmill.sources.contract import SALES_CONTRACT, ColumnRule, Contract
from seriesmill.sources.csv import read_sales_csv
from seriesmill.sources.sales import daily_sales, line_sales, read_lines, time_split
from seriesmill.streaming import arrivals

CUT = dt.date(2001, 10, 1)
#: Cutoffs whose residuals are sketched, and later ones to measure the intervals on.
SKETCHED = date_range("2001-06-03", "2001-07-29")[::7]
HELD_OUT = date_range("2001-08-05", "2001-09-02")[::7]
LAST_DAY = CUT - dt.timedelta(days=1)
CUTOFFS = date_range("2001-09-30", "2001-10-07")
#: Ends of the deliveries of the hold-out; the last one brings all that is left.
DELIVERIES = (dt.date(2001, 10, 2), dt.date(2001, 10, 21), None)
HISTORY_AND_90 = ForecastSpec(h=90, include_history=True)
ONE_SERIES = "store = 1 AND item = 1"
LIMITED = Contract(
    columns=(*SALES_CONTRACT.columns[:3], dataclasses.replace(SALES_CONTRACT.columns[3], high="100")),
    unique_key=SALES_CONTRACT.unique_key,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def rounded(spark: SparkSession, folder: str) -> DataFrame:
        df = build(spark, folder)
        doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
        return df.withColumns({c: F.round(c, 4) for c in doubles})

    QUERIES[build.__name__] = rounded
    return build


def train(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sales(spark, folder, end=CUT)


def holdout(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sales(spark, folder, start=CUT)


def saved_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out sales out of one daily table, for plans that read them several times."""
    return time_split(tables.materialise(daily_sales(spark, folder), "sales"), CUT)


# Exploration and split


@query
def sales_by_year(spark, folder):
    return explore.sales_by_year(daily_sales(spark, folder))


@query
def sales_by_month(spark, folder):
    return explore.sales_by_month(daily_sales(spark, folder))


@query
def weekday_profile(spark, folder):
    return explore.weekday_profile(daily_sales(spark, folder))


@query
def store_month_profile(spark, folder):
    return explore.store_month_profile(daily_sales(spark, folder))


@query
def item_month_profile(spark, folder):
    return explore.item_month_profile(daily_sales(spark, folder), 1)


@query
def item_all_month_profile(spark, folder):
    return explore.month_profile(daily_sales(spark, folder), ["item", "store"])


@query
def max_date(spark, folder):
    return explore.max_date(daily_sales(spark, folder))


@query
def split_summary(spark, folder):
    return explore.split_summary(daily_sales(spark, folder), CUT)


@query
def series_list(spark, folder):
    return explore.series_list(daily_sales(spark, folder))


@query
def train_sales(spark, folder):
    return time_split(daily_sales(spark, folder), CUT)[0]


@query
def holdout_sales(spark, folder):
    return time_split(daily_sales(spark, folder), CUT)[1]


@query
def sales_preview(spark, folder):
    return daily_sales(spark, folder).orderBy("date", "store", "item").limit(10)


# Forecast per series


@query
def series_forecast(spark, folder):
    return forecast(train(spark, folder))


@query
def series_forecast_500(spark, folder):
    return forecast(daily_sales(spark, folder, end=CUT, n_stores=10, n_items=50))


@query
def bucketed_series_forecast(spark, folder):
    name = "seriesmill_bucketed_sales"
    tables.save(
        train(spark, folder), name, path=shared_folder(spark, name), mode="overwrite",
        bucket_by=(16, ["store", "item"]),
    )
    return forecast(tables.read_table(spark, name))


@query
def forecast_components(spark, folder):
    return components(train(spark, folder))


@query
def single_series_forecast(spark, folder):
    return forecast(train(spark, folder), spec=HISTORY_AND_90, where=ONE_SERIES)


@query
def single_series_fit_metrics(spark, folder):
    sales = train(spark, folder)
    fitted = forecast(sales, spec=HISTORY_AND_90, where=ONE_SERIES)
    return evaluate.fit_metrics(fitted, sales.where(ONE_SERIES), CUT)


@query
def actual_vs_forecast_slice(spark, folder):
    sales = train(spark, folder)
    return evaluate.actual_vs_forecast(forecast(sales, spec=HISTORY_AND_90), sales)


@query
def moment_forecast(spark, folder):
    return moments.moment_forecast(train(spark, folder))


@query
def zero_filled_forecast(spark, folder):
    return moments.moment_forecast(train(spark, folder), zero_fill=True)


@query
def zero_filled_forecast_1000(spark, folder):
    """A thousand sparse series; zeros up to the day before the cut, whenever the last sale was."""
    return moments.moment_forecast(daily_sales(spark, folder, end=CUT, n_stores=50, n_items=20), zero_fill=True, until=LAST_DAY)


# Top-down


@query
def item_daily_sales(spark, folder):
    return explore.item_daily_sales(train(spark, folder))


@query
def store_item_share(spark, folder):
    return store_share(train(spark, folder))


@query
def item_forecast(spark, folder):
    return forecast(train(spark, folder), ["item"])


@query
def allocated_forecast(spark, folder):
    return top_down_forecast(saved_split(spark, folder)[0])


# Comparison


def overview(spark: SparkSession, folder: str) -> DataFrame:
    return strategy_overview(*saved_split(spark, folder))


@query
def prediction_overview(spark, folder):
    return overview(spark, folder)


@query
def overview_of_one_item(spark, folder):
    overview(spark, folder).createOrReplaceTempView("seriesmill_overview")
    return spark.sql(
        "SELECT * FROM seriesmill_overview WHERE item = :item ORDER BY date, store", args={"item": 1}
    )


@query
def series_metrics(spark, folder):
    return evaluate.error_metrics(overview(spark, folder), model=evaluate.PER_SERIES)


@query
def allocation_metrics(spark, folder):
    pairs = overview(spark, folder).select("store", "item", "y", F.col("yhat_agg").alias("yhat"))
    return evaluate.error_metrics(pairs, model=evaluate.TOP_DOWN)


@query
def strategy_comparison(spark, folder):
    return evaluate.compare_strategies(overview(spark, folder))


@query
def champion_model(spark, folder):
    return evaluate.champion(evaluate.compare_strategies(overview(spark, folder)))


@query
def strategy_wins(spark, folder):
    return evaluate.strategy_wins(evaluate.compare_strategies(overview(spark, folder)))


@query
def miss_by_store(spark, folder):
    return evaluate.pooled_miss(overview(spark, folder), ["store"])


@query
def miss_by_item(spark, folder):
    return evaluate.pooled_miss(overview(spark, folder), ["item"])


@query
def unscored_sales(spark, folder):
    known, later = saved_split(spark, folder)
    return evaluate.unscored(later, forecast(known))


# Walk-forward


def walked(spark: SparkSession, folder: str) -> DataFrame:
    return walk_forward.walk_forward(daily_sales(spark, folder, end="2001-10-07"), CUTOFFS)


def walked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    sales = tables.materialise(daily_sales(spark, folder, end="2001-10-08"), "sales")
    return evaluate.with_actuals(walk_forward.walk_forward(sales, CUTOFFS), sales)


def both_walked(spark: SparkSession, folder: str) -> DataFrame:
    return strategies.walk_forward_overview(tables.materialise(daily_sales(spark, folder, end="2001-10-08"), "sales"), CUTOFFS)


@query
def walk_forward_forecast(spark, folder):
    return walked(spark, folder)


@query
def walk_forward_actuals(spark, folder):
    return walked_pairs(spark, folder)


@query
def walk_forward_metrics(spark, folder):
    return evaluate.coverage_metrics(walked_pairs(spark, folder), model=evaluate.PER_SERIES)


@query
def coverage_by_cutoff(spark, folder):
    return evaluate.coverage_metrics(walked_pairs(spark, folder), ["training_date"])


@query
def coverage_overall(spark, folder):
    return evaluate.coverage_overall(walked_pairs(spark, folder))


def stored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The stored forecasts of the cutoffs, read back by training date, with the sales they aimed at."""
    path = shared_folder(spark, "forecasts")
    walk_forward.store_forecasts(walked(spark, folder), path)
    stored = tables.read_table(spark, path).where(F.col("training_date").isin(CUTOFFS))
    return evaluate.with_actuals(stored, daily_sales(spark, folder))


@query
def stored_forecast_actuals(spark, folder):
    return stored_pairs(spark, folder)


@query
def stored_forecast_metrics(spark, folder):
    return evaluate.coverage_metrics(stored_pairs(spark, folder), model=evaluate.PER_SERIES)


@query
def walk_forward_overview(spark, folder):
    return both_walked(spark, folder)


@query
def walk_forward_strategy_metrics(spark, folder):
    """Both strategies at every cutoff: errors by training date and strategy."""
    stacked = both_walked(spark, folder).selectExpr(
        "training_date", "y", f"stack(2, '{evaluate.PER_SERIES}', yhat, '{evaluate.TOP_DOWN}', yhat_agg) AS (model, yhat)"
    )
    return evaluate.error_metrics(stacked, ["training_date", "model"])


@query
def shares_at_cutoffs(spark, folder):
    return shares_at(daily_sales(spark, folder, end="2001-10-07"), CUTOFFS)


@query
def routed_forecast(spark, folder):
    """Three training dates, each series forecast by the strategy that had scored best until then."""
    dates = CUTOFFS[-3:]
    sales = tables.materialise(daily_sales(spark, folder, end="2001-10-08"), "sales")
    scores = tables.materialise(strategies.walk_forward_overview(sales, CUTOFFS), "scores")
    direct = walk_forward.walk_forward(sales, dates)
    return evaluate.route(direct, strategies.allocated_walk_forward(sales, dates), evaluate.champions_at(scores, dates))


@query
def calibrated_coverage(spark, folder):
    """Coverage by days ahead of the normal and the calibrated interval, on cutoffs that the residuals do not come from."""
    sales = tables.materialise(daily_sales(spark, folder, end="2001-09-05"), "sales")
    walked_week = walk_forward.walk_forward(sales, [*SKETCHED, *HELD_OUT], spec=ForecastSpec(h=7, origin="cutoff"))
    pairs = tables.materialise(evaluate.with_actuals(walked_week, sales), "pairs")
    # Two sketches, as two runs would leave them, merged.
    parts = [calibrate.residual_sketch(pairs.where(F.col("training_date").isin(dates))) for dates in (SKETCHED[:5], SKETCHED[5:])]
    quantiles = calibrate.sketch_quantiles(calibrate.merge_sketches(parts[0].union(parts[1])))
    held_out = pairs.where(F.col("training_date").isin(HELD_OUT))
    own = calibrate.coverage_by_step(calibrate.calibrated(held_out, quantiles))
    own = own.select("step", F.col("accuracy").alias("calibrated_accuracy"), F.col("stocked").alias("calibrated_stocked"))
    return calibrate.coverage_by_step(held_out).join(own, "step")


# Tables, versions and the run ledger


@query
def saved_once_sales(spark, folder):
    """A second save without a mode fails and leaves the table as it was."""
    path = shared_folder(spark, "once")
    tables.save(daily_sales(spark, folder), path)
    try:
        tables.save(daily_sales(spark, folder).limit(0), path)
    except AnalysisException:
        return tables.read_table(spark, path)
    raise AssertionError("an existing table was saved over")


@query
def database_sales(spark, folder):
    """A table in a database of its own, dropped and saved anew before it is read."""
    before, name = spark.catalog.currentDatabase(), f"seriesmill_{uuid.uuid4().hex[:12]}"
    tables.use_database(spark, name, shared_folder(spark, name))
    try:
        tables.save(daily_sales(spark, folder, end=CUT), "sales")
        tables.drop_table(spark, "sales")
        tables.save(daily_sales(spark, folder), "sales")
        return tables.materialise(tables.read_table(spark, "sales"), "sales")
    finally:
        spark.catalog.setCurrentDatabase(before)
        tables.drop_database(spark, name)


def grown_table(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "grown")
    versions = walk_forward.version_arrivals(daily_sales(spark, folder, end="2001-10-07"), CUT)
    tables.save(versions, path, partition_by=[tables.VERSION])
    redelivered = versions.where(F.col(tables.VERSION) == 3)
    tables.save_partition(redelivered, path, tables.VERSION)
    return tables.read_table(spark, path)


@query
def catalog_table_sales(spark, folder):
    name = "seriesmill_daily_sales"
    tables.save(daily_sales(spark, folder), name, path=shared_folder(spark, name), mode="overwrite")
    return tables.read_table(spark, name)


@query
def arrival_history(spark, folder):
    return tables.history(grown_table(spark, folder))


@query
def latest_arrival(spark, folder):
    return tables.latest_version(grown_table(spark, folder)).select(
        F.col(tables.VERSION).cast("bigint").alias(tables.VERSION)
    )


@query
def snapshot_sales(spark, folder):
    return tables.snapshot(grown_table(spark, folder), 3).drop(tables.VERSION)


@query
def changes_between_versions(spark, folder):
    """Versions 2 and 3 of the growing table, where 3 also corrects item 1 of the day before and takes item 2 of it back."""
    grown = walk_forward.version_arrivals(daily_sales(spark, folder, end="2001-10-07"), CUT)
    second = grown.where(F.col(tables.VERSION) == 2).withColumn(tables.VERSION, F.lit(3).cast("bigint"))
    corrected = second.where("item = 1").withColumn("sales", F.col("sales") + 1)
    removed = second.where("item = 2").withColumn("sales", F.lit(None).cast("bigint"))
    path = shared_folder(spark, "changes")
    tables.save(grown.unionByName(corrected).unionByName(removed).unionByName(second.where("item = 3")), path, partition_by=[tables.VERSION])
    return tables.version_changes(tables.read_table(spark, path), 2, 3)


@query
def run_ledger(spark, folder):
    params = walk_forward.run_parameters(walk_forward.NEXT_DAY)
    versions = walk_forward.version_arrivals(daily_sales(spark, folder, end="2001-10-07"), CUT)
    path = shared_folder(spark, "ledger")
    rows = walk_forward.ledger_rows(walked(spark, folder), versions, CUTOFFS, params)
    walk_forward.append_runs(rows, path)
    walk_forward.append_runs(rows.where(F.col("training_date") == F.lit(CUT)), path)
    names = [F.col("params")[n].alias(f"param_{n}") for n in sorted(params)]
    return walk_forward.read_runs(spark, path).select(
        "run_id", "training_date", "data_version", *names, "n_series", "n_rows"
    )


@query
def idempotent_forecast_store(spark, folder):
    path = shared_folder(spark, "forecasts")
    forecasts = walked(spark, folder)
    walk_forward.store_forecasts(forecasts, path)
    walk_forward.store_forecasts(forecasts.where(F.col("training_date") == F.lit(CUT)), path)
    return tables.read_table(spark, path)


# Quality


@query
def csv_sales(spark, folder):
    path = shared_folder(spark, "csv")
    daily_sales(spark, folder).write.option("header", True).csv(path)
    return read_sales_csv(spark, path)[0]


@query
def csv_quarantined_sales(spark, folder):
    path = shared_folder(spark, "csv")
    text = F.when(F.col("date") >= F.lit(CUT), F.concat("sales", F.lit(" units"))).otherwise(F.col("sales").cast("string"))
    daily_sales(spark, folder).withColumn("sales", text).write.option("header", True).csv(path)
    return read_sales_csv(spark, path)[1].select(F.col("_corrupt_record").alias("raw_text"), F.col("_rule").alias("rule"))


@query
def enforced_sales(spark, folder):
    return quality.enforce(daily_sales(spark, folder), LIMITED)[0]


@query
def quarantined_sales(spark, folder):
    return quality.enforce(daily_sales(spark, folder), LIMITED)[1].withColumnRenamed("_rule", "rule")


@query
def quarantined_by_every_rule(spark, folder):
    """Sales as text, with days, numbers and values that break each kind of rule."""
    broken = """CASE WHEN item = 2 THEN NULL WHEN item = 3 THEN concat('-', sales) WHEN item = 4 THEN concat(sales, '.5')
        WHEN item = 5 THEN '100000' ELSE CAST(sales AS STRING) END"""
    rows = daily_sales(spark, folder).withColumns({"date": F.expr("CASE WHEN store <> 5 THEN date END"), "sales": F.expr(broken)})
    return quality.enforce(rows, LIMITED)[1].withColumnRenamed("_rule", "rule")


@query
def forecast_without_missing_values(spark, folder):
    """Sales of every fifth day are NULL: those days are not seen, as if they had no row."""
    missing = F.when(F.dayofmonth("date") % 5 != 0, F.col("sales"))
    return forecast(train(spark, folder).withColumn("sales", missing))


@query
def allocation_of_unmatched_items(spark, folder):
    """A share without a forecast (item 1) and a forecast without a share (item 2)."""
    sales = tables.materialise(train(spark, folder), "sales")
    return allocate(forecast(sales.where("item <> 1"), ["item"]), store_share(sales.where("item <> 2")))


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_sales(read_lines(spark, folder), keep=["l_orderkey", "l_linenumber"])
    return rows.withColumn("sales", F.col("sales").cast("bigint"))


def redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales as version 0, and those of item 1 once more as version 1 with one unit more."""
    first = daily_sales(spark, folder).withColumn(tables.VERSION, F.lit(0))
    again = first.where("item = 1").withColumns({"sales": F.col("sales") + 1, tables.VERSION: F.lit(1)})
    return first.union(again)


@query
def deduplicated_sales(spark, folder):
    return quality.dedup(redelivered(spark, folder), ["date", "store", "item"], [tables.VERSION]).drop(tables.VERSION)


def layered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        paths = layers.build_layers(redelivered(spark, folder), shared_folder(spark, "layers"), latest_by=[tables.VERSION])
        return tables.read_table(spark, paths[name])

    build.__name__ = f"layered_{name}"
    return build


for aggregate in layers.AGGREGATES:
    query(layered(aggregate))


def profiled(spark: SparkSession, folder: str) -> DataFrame:
    return quality.profile(daily_sales(spark, folder), custom={"mean_sales": "avg(sales)"})


@query
def quality_profile(spark, folder):
    return profiled(spark, folder)


@query
def quality_alerts(spark, folder):
    rules = [
        quality.AlertRule("*", "rows", low=1),
        quality.AlertRule("sales", "max", high=100),
        quality.AlertRule("sales", "nulls", high=0),
        quality.AlertRule("date", "missing_days", high=0),
        quality.AlertRule("*", "mean_sales", low=10, high=1000),
    ]
    return quality.alerts(profiled(spark, folder), rules)


@query
def contract_violations(spark, folder):
    promised = dataclasses.replace(LIMITED, columns=(*LIMITED.columns, ColumnRule("promotion", "string")))
    return quality.contract_violations(raw_lines(spark, folder), promised)


@query
def series_sample(spark, folder):
    return quality.sample_series(daily_sales(spark, folder), ["store", "item"], 4)


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    item = table("part").groupBy((F.col("p_partkey") % 10 + 1).cast("int").alias("item")).agg(
        F.count("*").alias("n_parts"), F.avg("p_retailprice").alias("mean_price")
    )
    store = (
        table("supplier")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy((F.col("s_suppkey") % 5 + 1).cast("int").alias("store"))
        .agg(F.count("*").alias("n_suppliers"), F.count_distinct("n_regionkey").alias("n_regions"))
    )
    day = table("orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("n_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("n_filled")
    )
    return quality.enrich(
        daily_sales(spark, folder),
        quality.Source("part", item, ("item",)),
        quality.Source("supplier", store, ("store",)),
        quality.Source("orders", day, ("date",)),
    )


@query
def enriched_sales(spark, folder):
    return enriched(spark, folder)


@query
def enrichment_coverage(spark, folder):
    return quality.enrichment_coverage(enriched(spark, folder), ["part", "supplier", "orders"])


def promotions(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    """A week from the first order of each month, by item and whatever else."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        (F.col("o_custkey") % 10 + 1).cast("int").alias("item"), F.col("o_orderdate").cast("date").alias("day"), *by
    )
    return orders.groupBy("item", *by, F.trunc("day", "month").alias("month")).agg(
        F.min("day").alias("start"), F.date_add(F.min("day"), 6).alias("end"), F.count("*").alias("n_orders")
    ).drop("month")


@query
def sales_in_promotions(spark, folder):
    """Promotions end with their month, so that no two of an item overlap."""
    weeks = promotions(spark, folder).withColumn("end", F.least("end", F.last_day("start")))
    return periods.enrich_with_periods(daily_sales(spark, folder), periods.Periods("promotion", weeks, ("item",)))


@query
def overlapping_promotions(spark, folder):
    weeks = promotions(spark, folder, "o_orderpriority")
    return periods.count_periods(daily_sales(spark, folder), periods.Periods("promotion", weeks, ("item",)))


def stratified(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    series = representative.series_strata(daily_sales(spark, folder, n_stores=10, n_items=50), strata=5)
    return series, representative.representative_series(series, per_stratum=20)


@query
def representative_sales(spark, folder):
    sales = daily_sales(spark, folder, n_stores=10, n_items=50)
    return representative.representative_copy(sales, stratified(spark, folder)[1])


@query
def representative_strata(spark, folder):
    return representative.stratum_report(*stratified(spark, folder))


def drifted(spark: SparkSession, folder: str) -> DataFrame:
    """States of the growing table are stored version by version; version 3 is compared with what came before."""
    path = shared_folder(spark, "states")
    grown = grown_table(spark, folder)
    for part in (F.col(tables.VERSION) <= 2, F.col(tables.VERSION) > 2):
        tables.save_partition(profiles.profile_state(grown.where(part), ["store", "item", "sales", "date"]), path, tables.VERSION)
    return profiles.drift(tables.read_table(spark, path), 3).where("NOT (`column` = 'date' AND metric = 'distinct')")


@query
def version_drift(spark, folder):
    """Distinct days are left out: their sketched number is near the exact one, not equal to it (tested elsewhere)."""
    return drifted(spark, folder)


@query
def version_drift_alerts(spark, folder):
    rules = [
        quality.AlertRule("sales", "p50", low=-0.1, high=0.1),
        quality.AlertRule("sales", "null_share", high=0),
        quality.AlertRule("item", "distinct", low=0),
        quality.AlertRule("sales", "mean"),
    ]
    return profiles.drift_alerts(drifted(spark, folder), rules)


# Retraining by deliveries


@query
def incremental_walk_forward(spark, folder):
    """Day by day: a version of the sales lands, and the next day is forecast from stored moments."""
    base = shared_folder(spark, "retrain")
    sales = tables.materialise(daily_sales(spark, folder, end="2001-10-07"), "sales")
    arrivals.seed(sales.where(F.col("date") < F.lit(CUTOFFS[0])), f"{base}/table")
    for version, day in enumerate(CUTOFFS, 1):
        rows = sales.where(F.col("date") == F.lit(day)).withColumn(tables.VERSION, F.lit(version).cast("bigint"))
        tables.save_partition(rows, f"{base}/table", tables.VERSION)
        retrain.train_on_version(spark, f"{base}/table", version, f"{base}/forecasts")
    return tables.read_table(spark, f"{base}/forecasts")


@query
def corrected_forecast_store(spark, folder):
    """The hold-out's first days are delivered, then item 1 of some of them once more with one unit more."""
    base = shared_folder(spark, "retrain")
    sales = tables.materialise(daily_sales(spark, folder, end="2001-10-07"), "sales")
    arrivals.seed(sales.where(F.col("date") < F.lit(CUT)), f"{base}/table")
    first = sales.where(F.col("date") >= F.lit(CUT))
    again = first.where("item = 1 AND date BETWEEN '2001-10-02' AND '2001-10-03'").withColumn("sales", F.col("sales") + 1)
    for delivery in (first, again):
        delivery.coalesce(1).write.mode("append").parquet(f"{base}/in")
        arrivals.run_arrivals(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", f"{base}/forecasts")
    return tables.read_table(spark, f"{base}/forecasts")


# Stream and grouped map


def deliver(spark: SparkSession, folder: str, base: str, forecasts: str | None = None) -> None:
    """Hand the hold-out to the stream in deliveries of several days."""
    start = CUT
    for end in DELIVERIES:
        daily_sales(spark, folder, start=start, end=end).write.mode("append").parquet(f"{base}/in")
        arrivals.run_arrivals(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", forecasts)
        start = end


@query
def arrival_stream_sales(spark, folder):
    base = shared_folder(spark, "stream")
    deliver(spark, folder, base)
    return arrivals.current_sales(spark, f"{base}/table")


@query
def arrival_stream_forecast(spark, folder):
    base = shared_folder(spark, "stream")
    arrivals.seed(train(spark, folder), f"{base}/table")
    deliver(spark, folder, base, f"{base}/forecasts")
    return tables.read_table(spark, f"{base}/forecasts")


@query
def grouped_map_forecast(spark, folder):
    return grouped_forecast(train(spark, folder), ["store", "item"], ForecastSpec(), closed_form_model)


@query
def grouped_map_forecast_500(spark, folder):
    sales = daily_sales(spark, folder, end=CUT, n_stores=10, n_items=50)
    return grouped_forecast(sales, ["store", "item"], ForecastSpec(), closed_form_model)


@query
def grouped_map_weekday_mean(spark, folder):
    return grouped_forecast(train(spark, folder), ["store", "item"], ForecastSpec(), weekday_mean_model)


@query
def grouped_map_item_forecast(spark, folder):
    return grouped_forecast(train(spark, folder), ["item"], ForecastSpec(), weekday_mean_model, literals={"h": 14})


@query
def grouped_map_walk_forward(spark, folder):
    return grouped_forecast(
        daily_sales(spark, folder, end="2001-10-07"),
        ["store", "item"],
        walk_forward.NEXT_DAY,
        weekday_mean_model,
        cutoffs=CUTOFFS,
    )


@query
def grouped_map_walk_forward_by_cost(spark, folder):
    return grouped_forecast(
        daily_sales(spark, folder, end="2001-10-07"),
        ["store", "item"],
        walk_forward.NEXT_DAY,
        weekday_mean_model,
        cutoffs=CUTOFFS,
        cost="n",
    )
