"""Behaviours that are easy to get wrong, each on a few literal rows."""

import datetime as dt
import math

import pytest
from conftest import sales_frame, tuples
from pyspark.sql import functions as F

from seriesmill.functions.dates import date_range, weekday_index
from seriesmill.operators import evaluate, explore
from seriesmill.operators.allocate import allocate, store_share
from seriesmill.operators.forecast import ForecastSpec, fit, forecast
from seriesmill.plans.walk_forward import walk_forward
from seriesmill.sources.csv import read_sales_csv
from seriesmill.sources.sales import time_split

D = dt.date


def series(start, values, store=1, item=1):
    first = D.fromisoformat(start)
    return [(str(first + dt.timedelta(days=n)), store, item, v) for n, v in enumerate(values)]


def pairs_frame(spark, rows):
    return spark.createDataFrame(rows, "store INT, item INT, y DOUBLE, yhat DOUBLE, yhat_lower DOUBLE, yhat_upper DOUBLE")


def test_null_date_is_in_neither_part_but_counted(spark):
    sales = sales_frame(spark, [("2001-09-30", 1, 1, 5), ("2001-10-01", 1, 1, 6), ("2001-10-02", 1, 1, 7), (None, 1, 1, 8)])
    train, test = time_split(sales, "2001-10-01")
    assert (train.count(), test.count()) == (1, 2)
    assert tuples(explore.split_summary(sales, "2001-10-01")) == [(4, 1, 2, 1, 25.0)]


def test_csv_with_one_more_leading_column_is_rejected(spark, tmp_path):
    (tmp_path / "shifted.csv").write_text("id,date,store,item\n1,2017-01-01,1,1\n")
    good, _ = read_sales_csv(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)header"):
        good.collect()


def test_csv_bad_rows_are_set_aside_whatever_is_selected(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(
        "date,store,item,sales\n2017-01-01,1,1,5\n2017-01-02,1,x,6\n2017-01-03,,1,7\nnonsense\n2017-01-04,1,1,8,9\n"
    )
    good, bad = read_sales_csv(spark, str(tmp_path))
    assert tuples(good) == [(D(2017, 1, 1), 1, 1, 5)]
    assert good.count() == 1 and good.select("store").count() == 1
    assert bad.count() == 4
    assert sorted(r["_rule"] for r in bad.collect()) == ["malformed", "malformed", "malformed", "not_null:store"]


def test_days_beyond_the_horizon_are_unscored_and_reported(spark):
    train = sales_frame(spark, series("2017-11-01", [5] * 30))
    test = sales_frame(spark, series("2017-12-01", [5] * 31))
    predicted = forecast(train)
    assert evaluate.with_actuals(predicted, test).count() == 30
    assert tuples(evaluate.unscored(test, predicted)) == [(D(2017, 12, 31), 1, 1, 5)]


def test_horizon_starts_after_each_series_own_last_day(spark):
    sales = sales_frame(spark, series("2020-01-01", [3] * 10) + series("2020-01-01", [3] * 4, store=2))
    first = forecast(sales, spec=ForecastSpec(h=2)).groupBy("store").agg(F.min("ds"))
    assert tuples(first, "store") == [(1, D(2020, 1, 11)), (2, D(2020, 1, 5))]


def test_saturday_is_weekday_zero(spark):
    sales = sales_frame(spark, [("2020-01-03", 1, 1, 2), ("2020-01-04", 1, 1, 4), ("2020-01-05", 1, 1, 6)])
    assert tuples(sales.select(weekday_index(F.col("date"))), "date") == [(6,), (0,), (1,)]
    assert tuples(explore.weekday_profile(sales), "weekday") == [(2020, 0, 4.0), (2020, 1, 6.0), (2020, 6, 2.0)]


def test_weekday_profile_sums_a_day_before_it_averages(spark):
    sales = sales_frame(spark, [("2020-01-04", 1, 1, 2), ("2020-01-04", 2, 1, 4), ("2020-01-11", 1, 1, 10)])
    assert tuples(explore.weekday_profile(sales)) == [(2020, 0, 8.0)]


def test_month_profile_averages_over_the_years_seen_only(spark):
    sales = sales_frame(
        spark,
        [("2019-01-01", 1, 1, 1), ("2019-01-31", 1, 1, 2), ("2020-01-05", 1, 1, 9), ("2020-02-05", 1, 1, 4)],
    )
    assert tuples(explore.store_month_profile(sales), "month") == [(1, 1, 6.0), (2, 1, 4.0)]


def test_item_is_bound_as_a_parameter(spark):
    sales = sales_frame(spark, [("2020-01-05", 1, 1, 9), ("2020-01-05", 1, 2, 4)])
    assert tuples(explore.item_month_profile(sales, 2)) == [(1, 1, 4.0)]


def test_share_of_an_item_that_never_sold_is_null(spark):
    sales = sales_frame(spark, [("2020-01-01", 1, 1, 0), ("2020-01-01", 2, 1, 0), ("2020-01-01", 1, 2, 3)])
    assert tuples(store_share(sales), "item", "store") == [(1, 1, None, 0, 0), (1, 2, None, 0, 0), (2, 1, 1.0, 3, 3)]


def test_allocation_keeps_unmatched_rows_of_both_sides(spark):
    predicted = spark.createDataFrame([(1, D(2020, 1, 1), 10.0), (2, D(2020, 1, 1), 20.0)], "item INT, ds DATE, yhat DOUBLE")
    share = spark.createDataFrame([(1, 7, 0.25), (3, 7, 1.0)], "item INT, store INT, ratio DOUBLE")
    assert sorted(tuples(allocate(predicted, share)), key=lambda r: r[1]) == [
        (7, 1, D(2020, 1, 1), 2.5),
        (None, 2, D(2020, 1, 1), None),
        (7, 3, None, None),
    ]


def test_allocation_equals_a_full_outer_join(spark):
    predicted = spark.createDataFrame(
        [(i, D(2020, 1, d), float(i * d)) for i in range(1, 6) for d in range(1, 4)], "item INT, ds DATE, yhat DOUBLE"
    )
    share = spark.createDataFrame([(i, s, i / (s + 1.0)) for i in range(3, 9) for s in range(3)], "item INT, store INT, ratio DOUBLE")
    expected = predicted.join(share, "item", "outer").select("store", "item", "ds", (F.col("yhat") * F.col("ratio")).alias("yhat"))
    assert sorted(map(str, tuples(allocate(predicted, share)))) == sorted(map(str, tuples(expected)))


def test_value_on_a_bound_is_neither_accurate_nor_stocked(spark):
    upper = pairs_frame(spark, [(1, 1, 9.0, 5.0, 1.0, 9.0)])
    assert tuples(evaluate.coverage_overall(upper)) == [(0.0, 0.0)]
    lower = pairs_frame(spark, [(1, 1, 1.0, 5.0, 1.0, 9.0)])
    assert tuples(evaluate.coverage_overall(lower)) == [(0.0, 1.0)]


@pytest.mark.parametrize("missing", [None, math.nan])
def test_missing_bound_is_a_miss(spark, missing):
    pairs = pairs_frame(spark, [(1, 1, 5.0, 5.0, 1.0, missing), (1, 1, 5.0, 5.0, 1.0, 9.0)])
    row = evaluate.coverage_metrics(pairs).first()
    assert (row["n"], row["accuracy"], row["stocked"]) == (2, 0.5, 0.5)
    assert tuples(evaluate.coverage_overall(pairs)) == [(0.5, 0.5)]


def test_errors_count_missing_pairs_apart(spark):
    pairs = pairs_frame(spark, [(1, 1, 5.0, 8.0, 0.0, 0.0), (1, 1, 5.0, 1.0, 0.0, 0.0), (1, 1, None, 1.0, 0.0, 0.0), (1, 1, 2.0, math.nan, 0.0, 0.0)])
    row = evaluate.error_metrics(pairs, model="m").first().asDict()
    assert row == {"store": 1, "item": 1, "n": 2, "n_null": 2, "mse": 12.5, "rmse": math.sqrt(12.5), "mae": 3.5, "model": "m"}


def test_rows_without_value_or_day_are_dropped_at_both_grains(spark):
    clean = series("2020-01-01", [4, 6, 5, 7, 8, 3, 9, 5])
    dirty = clean + [("2020-01-03", 1, 1, None), (None, 1, 1, 1000)]
    for keys in (["store", "item"], ["item"]):
        a, b = (forecast(sales_frame(spark, rows), keys) for rows in (clean, dirty))
        assert tuples(a, "ds") == tuples(b, "ds")


def test_nan_values_are_dropped(spark):
    rows = series("2020-01-01", [4, 6, 5, 7, 8, 3, 9, 5])
    good = sales_frame(spark, rows).withColumn("sales", F.col("sales").cast("double"))
    worse = good.unionByName(good.limit(1).withColumn("date", F.lit(D(2020, 2, 1))).withColumn("sales", F.lit(math.nan)))
    assert tuples(forecast(worse), "ds") == tuples(forecast(good), "ds")


def test_walk_forward_targets_the_day_after_each_cutoff_even_without_arrivals(spark):
    sales = sales_frame(spark, series("2001-09-01", [5, 6, 7, 8] * 7))  # ends on 28 September
    out = walk_forward(sales, date_range("2001-09-30", "2001-10-03"))
    assert tuples(out.select("training_date", "ds"), "ds") == [
        (D(2001, 9, 30), D(2001, 10, 1)), (D(2001, 10, 1), D(2001, 10, 2)), (D(2001, 10, 2), D(2001, 10, 3))
    ]


def test_walk_forward_sees_nothing_after_the_cutoff(spark):
    past = series("2001-09-01", [5, 6, 7, 8, 3, 4, 9] * 4)
    later = series("2001-09-29", [900] * 10)
    a = walk_forward(sales_frame(spark, past), ["2001-09-28"])
    b = walk_forward(sales_frame(spark, past + later), ["2001-09-28"])
    assert tuples(a) == tuples(b)


def test_date_range_excludes_its_end():
    assert date_range("2017-11-30", "2017-12-07")[-1] == D(2017, 12, 6)


def test_slice_covers_the_last_year_and_the_horizon(spark):
    sales = sales_frame(spark, series("2018-01-01", [5, 6, 7] * 300))
    out = evaluate.actual_vs_forecast(forecast(sales, spec=ForecastSpec(h=90, include_history=True)), sales)
    last = D(2018, 1, 1) + dt.timedelta(days=899)
    low, high, n, known = out.agg(F.min("ds"), F.max("ds"), F.count("*"), F.count("y")).first()
    assert (low, high, n, known) == (last - dt.timedelta(days=364), last + dt.timedelta(days=90), 455, 365)


def test_single_row_series_gets_its_mean_without_bounds(spark):
    out = forecast(sales_frame(spark, series("2020-03-04", [7])), spec=ForecastSpec(h=3))
    assert [(r["yhat"], r["yhat_lower"], r["yhat_upper"]) for r in out.collect()] == [(7.0, None, None)] * 3


def test_series_with_a_falling_trend_stays_positive(spark):
    out = forecast(sales_frame(spark, series("2020-01-01", list(range(60, 0, -1)))), spec=ForecastSpec(h=90))
    assert out.where("yhat <= 0").count() == 0


def test_origin_cutoff_needs_cutoffs(spark):
    with pytest.raises(ValueError):
        forecast(sales_frame(spark, series("2020-01-01", [1, 2])), spec=ForecastSpec(origin="cutoff"))


def test_walk_forward_needs_a_cutoff(spark):
    with pytest.raises(ValueError, match="cutoff"):
        walk_forward(sales_frame(spark, series("2020-01-01", [1, 2])), [])


@pytest.mark.parametrize("wrong", [{"h": 0}, {"level": 1.0}, {"mode": "additive"}, {"origin": "now"}])
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        ForecastSpec(**wrong)


def test_rows_of_one_day_are_added_up(spark):
    whole = series("2020-01-01", [4, 6, 5, 7, 8, 3, 9, 5])
    halves = [(d, s, i, v - 1) for d, s, i, v in whole] + [(d, s, i, 1) for d, s, i, _ in whole]
    assert tuples(forecast(sales_frame(spark, whole)), "ds") == tuples(forecast(sales_frame(spark, halves)), "ds")
    assert fit(sales_frame(spark, halves)).first()["n"] == 8
