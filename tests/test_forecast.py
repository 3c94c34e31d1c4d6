"""Properties of the forecast, known signals, and the native form against a brute-force one."""

import datetime as dt
import math
from statistics import NormalDist, mean, stdev

import numpy as np
import pandas as pd
import pytest
from conftest import sales_frame, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registry.spark_queries import CUT, train
from seriesmill.operators import evaluate
from seriesmill.operators.allocate import allocate, store_share
from seriesmill.operators.forecast import DAY_ZERO, ForecastSpec, forecast, forecast_components
from seriesmill.operators.grouped import grouped_forecast, piecewise_seasonal_model, weekday_mean_model
from seriesmill.plans.strategies import allocated_forecast
from seriesmill.plans.walk_forward import walk_forward


def brute_force(observed, h, z=NormalDist().inv_cdf(0.975), after=None):
    """The closed form for one series, step by step in plain Python: [(day, yhat, lower, upper)]."""
    days = sorted(observed)
    t = {d: (d - DAY_ZERO).days for d in days}
    y = observed
    if len(days) > 1:
        tm, ym = mean(t.values()), mean(y.values())
        slope = sum((t[d] - tm) * (y[d] - ym) for d in days) / sum((t[d] - tm) ** 2 for d in days)
        intercept = ym - slope * tm
    else:
        slope, intercept = 0.0, mean(y.values())

    def trend(d):
        return max(intercept + slope * (d - DAY_ZERO).days, 0.01 * abs(mean(y.values())))

    def by(group, base):
        sums = {}
        for d in days:
            above, below = sums.get(group(d), (0.0, 0.0))
            sums[group(d)] = above + y[d], below + base(d)
        return {g: above / below if below else 1.0 for g, (above, below) in sums.items()}

    weekly = {g: max(v, 0.001) for g, v in by(lambda d: d.weekday(), trend).items()}
    yearly = by(lambda d: d.month, lambda d: trend(d) * weekly[d.weekday()])

    def value(d):
        return trend(d) * weekly.get(d.weekday(), 1.0) * yearly.get(d.month, 1.0)

    margin = z * stdev([y[d] - value(d) for d in days]) if len(days) > 1 else None
    ahead = [(after or days[-1]) + dt.timedelta(days=n + 1) for n in range(h)]
    return [(d, value(d), None if margin is None else value(d) - margin, None if margin is None else value(d) + margin) for d in ahead]


def rows_of(observed, store=1, item=1):
    return [(str(d), store, item, int(v)) for d, v in observed.items()]


def close(a, b):
    return a == b if a is None or b is None else math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.dates(dt.date(1999, 1, 1), dt.date(2001, 12, 31)), st.integers(0, 500), min_size=1, max_size=60),
        min_size=1,
        max_size=6,
    )
)
def test_equals_brute_force_on_random_series(spark, all_series):
    rows = [r for item, observed in enumerate(all_series) for r in rows_of(observed, item=item)]
    out = forecast(sales_frame(spark, rows), spec=ForecastSpec(h=40)).orderBy("item", "ds").collect()
    expected = [e for observed in all_series for e in brute_force(observed, 40)]
    assert len(out) == len(expected)
    for row, (ds, yhat, lower, upper) in zip(out, expected):
        assert row["ds"] == ds
        assert close(row["yhat"], yhat) and close(row["yhat_lower"], lower) and close(row["yhat_upper"], upper)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.dates(dt.date(2001, 1, 1), dt.date(2001, 6, 30)), st.integers(0, 500), min_size=1, max_size=50),
        min_size=1,
        max_size=4,
    ),
    st.sets(st.dates(dt.date(2000, 12, 20), dt.date(2001, 7, 10)), min_size=1, max_size=9),
)
def test_walk_forward_equals_brute_force_on_random_cutoffs(spark, all_series, cutoffs):
    rows = [r for item, observed in enumerate(all_series) for r in rows_of(observed, item=item)]
    out = walk_forward(sales_frame(spark, rows), sorted(cutoffs), spec=ForecastSpec(h=3, origin="cutoff"))
    got = out.orderBy("training_date", "item", "ds").collect()
    expected = [
        (cutoff, item, *e)
        for cutoff in sorted(cutoffs)
        for item, observed in enumerate(all_series)
        if (seen := {d: v for d, v in observed.items() if d <= cutoff})
        for e in brute_force(seen, 3, after=cutoff)
    ]
    assert len(got) == len(expected)
    for row, (cutoff, item, ds, yhat, lower, upper) in zip(got, expected):
        assert (row["training_date"], row["item"], row["ds"]) == (cutoff, item, ds)
        assert close(row["yhat"], yhat) and close(row["yhat_lower"], lower) and close(row["yhat_upper"], upper)


def test_a_year_of_cutoffs_runs_as_one_job(spark, small):
    cutoffs = [dt.date(2000, 10, 1) + dt.timedelta(days=n) for n in range(365)]
    sales = train(spark, small)
    out = walk_forward(sales, cutoffs)
    assert out.count() == 365 * sales.where("date <= '2000-10-01'").select("store", "item").distinct().count()
    some = out.where("training_date = '2001-03-05'").drop("training_date")
    alone = walk_forward(sales, ["2001-03-05"]).drop("training_date")
    assert tuples(some, "store", "item") == tuples(alone, "store", "item")


def test_results_do_not_depend_on_the_order_or_spread_of_the_rows(spark, small):
    sales = train(spark, small)
    results = []
    for partitions, order in ((1, "date"), (7, "sales"), (3, "item")):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions + 2))
        results.append(tuples(forecast(sales.repartition(partitions).sortWithinPartitions(order)), "store", "item", "ds"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_one_hot_series_among_many_small_ones(spark):
    start = dt.date(2000, 1, 1)
    hot = {start + dt.timedelta(days=n): 50 + n % 7 for n in range(400)}
    rows = rows_of(hot) * 5 + [r for i in range(2, 40) for r in rows_of({start + dt.timedelta(days=n): i for n in range(20)}, item=i)]
    out = forecast(sales_frame(spark, rows).where("item = 1"), spec=ForecastSpec(h=5)).orderBy("ds").collect()
    whole = forecast(sales_frame(spark, rows), spec=ForecastSpec(h=5)).where("item = 1").orderBy("ds").collect()
    assert out == whole
    expected = brute_force({d: 5 * v for d, v in hot.items()}, 5)
    assert all(close(r["yhat"], e[1]) for r, e in zip(whole, expected))


def test_known_signal_is_recovered(spark):
    """Weekday factors alone, and a line alone, without noise.

    The factors mirror around the middle of the week: over whole weeks they are then uncorrelated
    with time, so that the fitted line is exactly flat.
    """
    factor = [0.7, 0.9, 1.1, 1.6, 1.1, 0.9, 0.7]
    start = dt.date(2001, 1, 1)
    rows = [(str(start + dt.timedelta(days=n)), 1, 1, round(1_000_000 * factor[n % 7])) for n in range(364)]
    out = forecast(sales_frame(spark, rows), spec=ForecastSpec(h=14, yearly=False)).orderBy("ds").collect()
    for n, row in enumerate(out):
        assert math.isclose(row["yhat"], 1_000_000 * factor[(364 + n) % 7], rel_tol=1e-6)
    flat = [(str(start + dt.timedelta(days=n)), 1, 1, 1000 + 10 * n) for n in range(200)]
    line = forecast(sales_frame(spark, flat), spec=ForecastSpec(h=20, weekly=False, yearly=False)).orderBy("ds").collect()
    for n, row in enumerate(line):
        assert math.isclose(row["yhat"], 1000 + 10 * (200 + n), rel_tol=1e-6)
        assert math.isclose(row["yhat_upper"], row["yhat"], rel_tol=1e-6)


def test_rows_bounds_and_components(spark, small):
    sales = train(spark, small)
    n_series = sales.select("store", "item").distinct().count()
    out = forecast(sales)
    assert out.count() == 30 * n_series
    assert out.where("NOT (yhat_lower <= yhat AND yhat <= yhat_upper)").count() == 0
    parts = forecast_components(sales).where("abs(trend * weekly * yearly - yhat) > 1e-9")
    assert parts.count() == 0


def test_one_series_alone_equals_its_rows_in_the_full_run(spark, small):
    sales = train(spark, small)
    alone = forecast(sales, where="store = 2 AND item = 3")
    among = forecast(sales).where("store = 2 AND item = 3")
    assert tuples(alone, "ds") == tuples(among, "ds")


def test_history_is_predicted_on_the_days_seen(spark, small):
    sales = train(spark, small).where("store = 1 AND item = 1")
    out = forecast(sales, spec=ForecastSpec(h=90, include_history=True))
    assert out.count() == sales.count() + 90
    assert out.join(sales, out.ds == sales.date, "left_semi").count() == sales.count()


def test_wider_level_gives_wider_bounds(spark, small):
    sales = train(spark, small)
    wide, narrow = (forecast(sales, spec=ForecastSpec(level=p)).agg(F.avg(F.col("yhat_upper") - F.col("yhat_lower"))).first()[0] for p in (0.99, 0.5))
    assert wide > 2 * narrow


def test_walk_forward_with_one_cutoff_equals_a_plain_forecast(spark, small):
    sales = train(spark, small)
    spec = ForecastSpec(h=5, origin="series")
    once = walk_forward(sales, ["2001-09-30"], spec=spec).drop("training_date")
    assert tuples(once, "store", "item", "ds") == tuples(forecast(sales, spec=spec), "store", "item", "ds")


def test_many_cutoffs_equal_one_run_each(spark, small):
    sales = train(spark, small)
    cutoffs = ["2000-12-31", "2001-06-30", "2001-09-30"]
    together = tuples(walk_forward(sales, cutoffs), "training_date", "store", "item")
    apart = [r for c in cutoffs for r in tuples(walk_forward(sales, [c]), "training_date", "store", "item")]
    assert len(together) == len(apart)
    for a, b in zip(together, apart):
        assert a[:4] == b[:4] and all(close(x, y) for x, y in zip(a[4:], b[4:]))


def test_shares_add_up_and_allocation_keeps_the_item_forecast(spark, small):
    sales = train(spark, small)
    share = store_share(sales)
    assert share.groupBy("item").agg(F.sum("ratio").alias("s")).where("abs(s - 1) > 1e-9").count() == 0
    items = forecast(sales, ["item"])
    total = allocate(items, share).groupBy("item", "ds").agg(F.sum("yhat").alias("allocated"))
    assert total.join(items, ["item", "ds"]).where("abs(allocated - yhat) > 1e-6").count() == 0
    assert allocated_forecast(sales).count() == share.count() * 30


def test_champion_is_deterministic_and_skips_unscored_models(spark):
    metrics = spark.createDataFrame(
        [(1, 1, "b", 2.0), (1, 1, "a", 2.0), (1, 2, "a", 3.0), (1, 2, "b", None), (1, 3, "a", None)],
        "store INT, item INT, model STRING, rmse DOUBLE",
    )
    assert tuples(evaluate.champion(metrics), "item") == [(1, 1, "a", 2.0), (1, 2, "a", 3.0), (1, 3, None, None)]
    assert tuples(evaluate.strategy_wins(metrics).where("model IS NOT NULL")) == [("a", 2)]


def test_fit_metrics_score_only_rows_before_the_day(spark, small):
    sales = train(spark, small).where("store = 1 AND item = 1")
    fitted = forecast(sales, spec=ForecastSpec(h=90, include_history=True))
    mae, mse, rmse = evaluate.fit_metrics(fitted, sales, CUT).first()
    pairs = evaluate.with_actuals(fitted, sales).toPandas()
    error = pairs["y"].astype(float) - pairs["yhat"]
    assert close(mae, error.abs().mean()) and close(mse, (error**2).mean()) and close(rmse, math.sqrt(mse))


# Grouped map


def test_grouped_map_equals_a_loop_over_the_series(spark, small):
    sales = train(spark, small)
    out = grouped_forecast(sales, ["store", "item"], ForecastSpec(h=7), weekday_mean_model).toPandas()
    frame = sales.toPandas()
    for (store, item), rows in frame.groupby(["store", "item"]):
        history = pd.DataFrame({"ds": pd.to_datetime(rows["date"]), "y": rows["sales"].astype(float)}).sort_values("ds", ignore_index=True)
        days = pd.date_range(history["ds"].iloc[-1] + pd.Timedelta(days=1), periods=7)
        expected = weekday_mean_model(history, days, ForecastSpec(h=7))
        got = out[(out["store"] == store) & (out["item"] == item)].sort_values("ds")
        np.testing.assert_allclose(got["yhat"], expected["yhat"])
        np.testing.assert_allclose(got["yhat_upper"], expected["yhat_upper"])
    assert len(out) == 7 * len(frame.groupby(["store", "item"]))


def test_grouped_map_takes_settings_from_literal_keys(spark, small):
    sales = train(spark, small)
    by_literal = grouped_forecast(sales, ["item"], ForecastSpec(), weekday_mean_model, literals={"h": 3})
    direct = grouped_forecast(sales, ["item"], ForecastSpec(h=3), weekday_mean_model)
    assert by_literal.columns == ["item", "ds", "yhat", "yhat_lower", "yhat_upper"]
    assert tuples(by_literal, "item", "ds") == tuples(direct, "item", "ds")


def test_grouped_map_walks_forward_with_any_model(spark, small):
    sales = train(spark, small)
    spec = ForecastSpec(h=1, origin="cutoff")
    out = grouped_forecast(sales, ["store", "item"], spec, weekday_mean_model, cutoffs=["2001-09-29", "2001-09-30"])
    native = walk_forward(sales, ["2001-09-29", "2001-09-30"], spec=spec)
    keys = ["training_date", "store", "item", "ds"]
    assert tuples(out.select(keys), *keys) == tuples(native.select(keys), *keys)


def known_history(n, noise=0.0):
    days = pd.date_range("2000-01-01", periods=n)
    k = np.arange(n)
    trend = 100 + 0.05 * k
    season = 1 + 0.2 * np.sin(2 * np.pi * k / 7) + 0.3 * np.cos(2 * np.pi * k / 365.25)
    wobble = noise * np.random.default_rng(7).normal(size=n)
    return pd.DataFrame({"ds": days, "y": trend * season + wobble}), trend * season


def test_piecewise_model_recovers_a_known_signal():
    history, _ = known_history(1200)
    full, truth = known_history(1260)
    out = piecewise_seasonal_model(history, pd.DatetimeIndex(full["ds"][1200:]), ForecastSpec())
    np.testing.assert_allclose(out["yhat"], truth[1200:], rtol=0.02)


def test_piecewise_model_interval_covers_noise():
    history, _ = known_history(1200, noise=5.0)
    full, truth = known_history(1260)
    out = piecewise_seasonal_model(history, pd.DatetimeIndex(full["ds"][1200:]), ForecastSpec())
    half = (out["yhat_upper"] - out["yhat"]).iloc[0]
    assert 8.0 < half < 12.0


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_piecewise_model_accepts_short_histories(n):
    history, _ = known_history(n)
    out = piecewise_seasonal_model(history, pd.date_range("2000-06-01", periods=3), ForecastSpec(h=3))
    assert len(out) == 3 and out["yhat"].notna().all()


def test_a_falling_series_keeps_sane_indices(spark):
    """200 falling by 1.5% a day to 1: the line crosses zero, the indices stay near 1."""
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=n) for n in range(500)]
    observed = {d: max(1, round(200 * 0.985**n)) for n, d in enumerate(days)}
    spec = ForecastSpec(h=1, include_history=True)
    parts = forecast_components(sales_frame(spark, rows_of(observed)), spec=spec).collect()
    errors = [r["yhat"] - observed[r["ds"]] for r in parts if r["ds"] in observed]
    assert math.sqrt(mean(e * e for e in errors)) < stdev(observed.values())
    assert all(0.5 < r["weekly"] < 1.5 for r in parts)


def test_trend_and_weekday_factors_together_are_recovered_within_their_bound(spark):
    """A rising line times weekday factors over whole weeks: within 1.5% of the signal, not exact.

    The line is fitted before the indices, so that the factors tilt it a little.
    """
    factor = [0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3]
    days = [dt.date(2000, 1, 3) + dt.timedelta(days=n) for n in range(728)]
    signal = {d: (1000 + 10 * n) * factor[d.weekday()] for n, d in enumerate(days)}
    frame = sales_frame(spark, rows_of({d: round(v) for d, v in signal.items()}))
    spec = ForecastSpec(h=1, include_history=True, yearly=False)
    worst = max(abs(r["yhat"] / signal[r["ds"]] - 1) for r in forecast(frame, spec=spec).collect() if r["ds"] in signal)
    assert worst < 1.5e-2


def test_keys_may_be_named_like_columns_of_the_model(spark):
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=n) for n in range(30)]
    frame = sales_frame(spark, rows_of({d: 5 + n % 7 for n, d in enumerate(days)}))
    odd = frame.withColumnsRenamed({"store": "n", "item": "weekly"})
    assert tuples(forecast(odd, ["n", "weekly"]), "ds") == tuples(forecast(frame), "ds")
