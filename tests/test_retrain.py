"""Moments against rows, calendar counts against a full grid, and the stored forecasts after deliveries and corrections."""

import datetime as dt
import random

import pytest
from conftest import sales_frame
from pyspark.sql import functions as F

from seriesmill.operators import moments
from seriesmill.operators.forecast import ForecastSpec, forecast
from seriesmill.plans import retrain
from seriesmill.plans.walk_forward import walk_forward
from seriesmill.sources import tables
from seriesmill.streaming import arrivals

KEYS = ["store", "item"]
DAY = dt.date(2020, 1, 1)
SUMS = [*KEYS, *moments.CELL, *moments.SUMS]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def series_rows(n_days=420, seed=1):
    """A rising, a sparse and a steeply falling series, one of a single day, and rows without a day or a value."""
    r = random.Random(seed)
    rows = []
    for k in range(n_days):
        day = str(DAY + dt.timedelta(days=k))
        rows.append((day, 1, 1, 20 + k // 5 + r.randrange(8)))
        if r.random() < 0.2:
            rows.append((day, 1, 2, r.randrange(1, 9)))
        rows.append((day, 2, 1, max(0, 120 - k) + r.randrange(3)))
    return [*rows, ("2020-03-05", 2, 2, 7), (None, 1, 1, 5), ("2020-03-06", 2, 2, None)]


def close(a, b):
    order = [c for c in ("training_date", *KEYS, "ds") if c in a.columns]
    columns = [*order, "yhat", "yhat_lower", "yhat_upper"]
    x, y = ([tuple(r) for r in df.select(columns).orderBy(*order).collect()] for df in (a, b))
    assert len(x) == len(y) and x
    for p, q in zip(x, y):
        assert p[: len(order)] == q[: len(order)]
        for u, v in zip(p[len(order) :], q[len(order) :]):
            assert (u is None) == (v is None) and (u is None or abs(u - v) < 1e-6 * max(1, abs(v))), (p, q)


def listed(df):
    return sorted(tuple(r) for r in df.select(SUMS).collect())


def test_moments_can_be_split_merged_and_taken_out(spark):
    sales = sales_frame(spark, series_rows())
    whole = moments.cell_moments(sales)
    parts = [moments.cell_moments(sales.where(w)) for w in ("date < '2020-04-10'", "date >= '2020-04-10'")]
    assert listed(moments.merge_moments(parts[0].unionByName(parts[1]))) == listed(whole)
    late = moments.observations(sales.where("date >= '2020-04-10'"))
    assert listed(retrain.corrected_moments(whole, late, late.limit(0))) == listed(parts[0])
    assert whole.groupBy(*KEYS).count().agg(F.max("count")).first()[0] <= 84


@pytest.mark.parametrize("real", [False, True])
def test_moment_forecast_equals_the_forecast_from_rows(spark, real):
    """The falling series lies on the floor of its trend at the end, and goes through rows."""
    sales = sales_frame(spark, series_rows())
    if real:
        sales = sales.withColumn("sales", F.col("sales") * 1.25)
    spec = ForecastSpec(h=40)
    close(moments.moment_forecast(sales, spec=spec), forecast(sales, spec=spec))
    close(moments.moment_forecast(sales.withColumnsRenamed({"store": "s_t", "item": "n"}), ["s_t", "n"], spec).withColumnsRenamed({"s_t": "store", "n": "item"}), forecast(sales, spec=spec))


@pytest.mark.parametrize("until", [None, dt.date(2021, 6, 15)])
def test_zeros_from_the_calendar_equal_zeros_in_rows(spark, until):
    sales = sales_frame(spark, [*series_rows(), ("2016-02-29", 3, 1, 4), ("2020-12-31", 3, 1, 9)])
    found = moments.zero_filled(moments.cell_moments(sales), KEYS, until)
    grid = moments.zero_filled_rows(sales, KEYS, until)
    assert listed(found) == listed(moments.cell_moments(grid))
    close(moments.moment_forecast(sales, zero_fill=True, until=until), forecast(grid))


def test_zeros_make_no_row_per_day(spark):
    sales = sales_frame(spark, series_rows(30))
    plan = moments.zero_filled(moments.cell_moments(sales))._jdf.queryExecution().optimizedPlan().toString()
    made = [line.split("Generate ")[1] for line in plan.splitlines() if "Generate " in line]
    # Months of the whole calendar, and the 84 cells (a constant array).
    assert made and all("INTERVAL '1' MONTH" in g or "UnsafeArrayData" in g and "cell#" in g for g in made), made


def test_moments_hold_no_history(spark):
    with pytest.raises(ValueError):
        moments.moment_forecast(sales_frame(spark, series_rows(20)), spec=ForecastSpec(include_history=True))


def test_a_new_day_reads_no_history(spark, folder):
    """The table holds the new versions only: the state before them is all that is known of the past."""
    sales = sales_frame(spark, series_rows()).where("item <> 1 OR store <> 2").where("date IS NOT NULL AND sales IS NOT NULL")
    cut = DAY + dt.timedelta(days=415)
    retrain.seed_moments(sales.where(F.col("date") < F.lit(cut)), f"{folder}/fc_moments")
    days = [cut + dt.timedelta(days=k) for k in range(4)]
    for version, own in ((1, days[:1]), (2, days[1:])):  # one day, then several at once
        rows = sales.where(F.col("date").isin(own)).withColumn(tables.VERSION, F.lit(version).cast("bigint"))
        tables.save_partition(rows, f"{folder}/table", tables.VERSION)
        for _ in range(2):  # a batch that is run again changes nothing
            retrain.train_on_version(spark, f"{folder}/table", version, f"{folder}/fc")
    close(tables.read_table(spark, f"{folder}/fc"), walk_forward(sales, days))
    known = sales.where(F.col("date") <= F.lit(days[-1]))
    assert listed(retrain.read_moments(spark, f"{folder}/fc_moments", 2)) == listed(moments.cell_moments(known))


def deliver(spark, folder, df):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arrivals.run_arrivals(spark, f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint", f"{folder}/fc")


def test_corrections_and_late_days_redo_what_they_touch(spark, folder):
    sales = sales_frame(spark, series_rows(300)).where("date IS NOT NULL AND sales IS NOT NULL")
    cut = dt.date(2020, 10, 10)
    days = [cut + dt.timedelta(days=k) for k in range(6)]
    late = days[2]
    arrivals.seed(sales.where(F.col("date") < F.lit(cut)), f"{folder}/table")
    deliver(spark, folder, sales.where(F.col("date").isin([d for d in days if d != late])))
    before = {r["training_date"]: r["data_version"] for r in tables.read_table(spark, f"{folder}/fc_runs").collect()}
    assert before == {d: 1 for d in days if d != late}

    def holds(trained):
        current = arrivals.current_sales(spark, f"{folder}/table")
        close(tables.read_table(spark, f"{folder}/fc"), walk_forward(current, trained))

    # A day that comes late, a corrected one, and a new one, in one delivery.
    corrected = sales_frame(spark, [(str(days[3]), 1, 1, 400), (str(days[3]), 1, 2, 50)])
    new = dt.date(2020, 10, 16)
    deliver(spark, folder, sales.where(F.col("date").isin([late, new])).unionByName(corrected))
    holds([*days, new])
    after = {r["training_date"]: r["data_version"] for r in tables.read_table(spark, f"{folder}/fc_runs").collect()}
    assert after == {d: 1 for d in days[:2]} | {d: 2 for d in [*days[2:], new]}
    # A correction far back in the history makes every run stale.
    deliver(spark, folder, sales_frame(spark, [("2020-02-03", 2, 1, 1)]))
    holds([*days, new, dt.date(2020, 2, 3)])


def test_which_runs_are_stale(spark):
    d = lambda k: dt.date(2020, 5, k)
    trained = spark.createDataFrame([(d(1), 1), (d(2), 2), (d(3), 2), (d(4), 5)], "training_date DATE, data_version BIGINT")
    brought = spark.createDataFrame([(1, d(1)), (2, d(2)), (3, d(3)), (5, d(4)), (6, d(9))], f"{tables.VERSION} BIGINT, min_date DATE")
    assert [r[0] for r in retrain.stale_dates(trained, brought).collect()] == [d(3)]
    assert retrain.stale_dates(trained, brought.limit(0)).isEmpty()


def test_only_a_missing_table_counts_as_missing(spark, folder):
    assert not tables.exists(spark, f"{folder}/none") and not tables.exists(spark, "no_such_table")
    with open(f"{folder}/broken.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        tables.exists(spark, f"{folder}/broken.parquet")
