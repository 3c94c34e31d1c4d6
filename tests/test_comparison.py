"""Both strategies over several cutoffs, routing, calibrated intervals, key names, and what versions changed."""

import datetime as dt
import random

import pytest
from conftest import final_plan, sales_frame
from pyspark.sql import functions as F

from seriesmill.operators import calibrate, evaluate
from seriesmill.operators.allocate import shares_at, store_share
from seriesmill.operators.forecast import ForecastSpec
from seriesmill.operators.grouped import grouped_forecast, weekday_mean_model
from seriesmill.plans import strategies
from seriesmill.plans.walk_forward import walk_forward
from seriesmill.sources import tables

DAY = dt.date(2020, 1, 1)


def rows(n_days=80, seed=2):
    r = random.Random(seed)
    out = [(str(DAY + dt.timedelta(days=k)), s, i, r.randrange(40) * (s + i)) for k in range(n_days) for s in (1, 2, 3) for i in (1, 2) if r.random() < 0.8]
    # A store that opens late, an item that never sells, and rows without a day or a value.
    return [*out, (str(DAY + dt.timedelta(days=70)), 4, 1, 9), (str(DAY), 1, 3, 0), (None, 1, 1, 5), (str(DAY), 2, 3, None)]


def test_shares_at_a_cutoff_are_the_shares_of_the_sales_up_to_it(spark):
    sales = sales_frame(spark, rows())
    cutoffs = [DAY - dt.timedelta(days=1), DAY, DAY + dt.timedelta(days=30), DAY + dt.timedelta(days=75), DAY + dt.timedelta(days=900)]
    got = sorted(map(tuple, shares_at(sales, cutoffs).select("training_date", "item", "store", "ratio").collect()), key=str)
    expected = []
    for c in cutoffs:
        for r in store_share(sales.where(F.col("date") <= F.lit(c))).collect():
            expected.append((c, r["item"], r["store"], r["ratio"]))
    assert got == sorted(expected, key=str)


def test_shares_move_one_row_per_store_and_item(spark):
    """Behind the sums by bucket, the cutoffs are an array: their number adds no rows to the join."""
    sales = sales_frame(spark, rows())
    plan = final_plan(shares_at(sales, [DAY + dt.timedelta(days=k) for k in range(20)]))
    assert plan.index("explode") < plan.index("Join")  # explode stands above, after the join


def test_walk_forward_overview_is_each_cutoff_by_itself(spark):
    sales = sales_frame(spark, rows())
    cutoffs = [DAY + dt.timedelta(days=k) for k in (40, 60, 75)]
    got = {tuple(r)[:4]: tuple(r)[4:] for r in strategies.walk_forward_overview(sales, cutoffs).collect()}
    expected = {}
    for c in cutoffs:
        known = sales.where(F.col("date") <= F.lit(c))
        spec = ForecastSpec(h=1, origin="cutoff")
        shares = {(r["item"], r["store"]): r["ratio"] for r in store_share(known).collect()}
        items = {r["item"]: r["yhat"] for r in walk_forward(known, [c], ["item"], spec).collect()}
        actual = {(r["store"], r["item"]): r["sales"] for r in sales.where(F.col("date") == F.lit(c + dt.timedelta(days=1))).collect()}
        for r in walk_forward(known, [c], spec=spec).collect():
            key = (r["store"], r["item"])
            if key in actual:
                share = shares[key[::-1]]
                expected[c, c + dt.timedelta(days=1), *key] = (float(actual[key]), r["yhat"], None if share is None else items[key[1]] * share)
    assert got.keys() == expected.keys() and got
    for key, values in got.items():
        assert all(a == b if a is None or b is None else abs(a - b) < 1e-9 for a, b in zip(values, expected[key]))


def test_a_champion_knows_no_score_of_its_future(spark):
    d = lambda k: DAY + dt.timedelta(days=k)
    ddl = "training_date DATE, date DATE, store INT, item INT, y DOUBLE, yhat DOUBLE, yhat_agg DOUBLE"
    overview = spark.createDataFrame(
        [(d(0), d(1), 1, 1, 5.0, 5.0, 9.0), (d(1), d(2), 1, 1, 5.0, 50.0, 5.0), (d(0), d(1), 1, 2, 5.0, None, 5.5), (d(1), d(2), 1, 3, None, 1.0, 2.0)], ddl
    )
    got = {(r["training_date"], r["item"]): r["model"] for r in evaluate.champions_at(overview, [d(0), d(1), d(2)]).collect()}
    assert got == {(d(1), 1): "store_item", (d(1), 2): "allocated", (d(2), 1): "allocated", (d(2), 2): "allocated", (d(2), 3): None}
    direct = spark.createDataFrame([(d(2), 1, i, d(3), 1.0) for i in (1, 2, 3, 4)], "training_date DATE, store INT, item INT, ds DATE, yhat DOUBLE")
    routed = evaluate.route(direct, direct.withColumn("yhat", F.lit(2.0)), evaluate.champions_at(overview, [d(2)]))
    assert sorted((r["item"], r["yhat"], r["model"]) for r in routed.collect()) == [
        (1, 2.0, "allocated"), (2, 2.0, "allocated"), (3, 1.0, "store_item"), (4, 1.0, "store_item"),
    ]


PAIRS = "training_date DATE, ds DATE, y DOUBLE, yhat DOUBLE, yhat_lower DOUBLE, yhat_upper DOUBLE"


def residuals(spark, ratios, step=1):
    return spark.createDataFrame([(DAY, DAY + dt.timedelta(days=step), 10.0 + 4.0 * z, 10.0, 6.0, 14.0) for z in ratios], PAIRS)


def test_quantiles_of_merged_sketches_are_within_their_error(spark):
    r = random.Random(7)
    ratios = [r.gauss(0.1, 0.6) ** 3 for _ in range(3000)] + [0.0] * 5
    parts = [calibrate.residual_sketch(residuals(spark, ratios[k::3])) for k in range(3)]
    merged = calibrate.merge_sketches(parts[0].union(parts[1]).union(parts[2]))
    whole = calibrate.residual_sketch(residuals(spark, ratios))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    ordered = sorted(ratios)
    for level in (0.5, 0.9, 0.99):
        (q,) = calibrate.sketch_quantiles(merged, level).collect()
        rank = int((1 - level) / 2 * len(ordered))
        for found, exact in ((q["lower"], ordered[rank]), (q["upper"], ordered[-rank - 1])):
            assert abs(found - exact) <= calibrate.ERROR * abs(exact) + 1e-9


def test_calibrated_intervals_cover_what_the_normal_ones_do_not(spark):
    """Skewed residuals: the normal interval covers too much or too little, the calibrated one its level."""
    r = random.Random(11)
    learn, test = ([r.expovariate(0.7) - 0.5 for _ in range(4000)] for _ in range(2))
    quantiles = calibrate.sketch_quantiles(calibrate.residual_sketch(residuals(spark, learn)), 0.9)
    held_out = residuals(spark, test)
    (own,) = calibrate.coverage_by_step(calibrate.calibrated(held_out, quantiles)).collect()
    (normal,) = calibrate.coverage_by_step(held_out).collect()
    assert abs(own["accuracy"] - 0.9) < 0.015 < abs(normal["accuracy"] - 0.9)
    # A step without residuals keeps its bounds; a pair without a margin or a value teaches nothing.
    other = residuals(spark, [0.5], step=2)
    assert [tuple(x) for x in calibrate.calibrated(other, quantiles).collect()] == [tuple(x) for x in other.collect()]
    nothing = spark.createDataFrame([(DAY, DAY, None, 1.0, 0.0, 2.0), (DAY, DAY, 5.0, 1.0, 1.0, 1.0), (DAY, DAY, 5.0, 1.0, None, None)], PAIRS)
    assert calibrate.residual_sketch(nothing).count() == 0


@pytest.mark.parametrize("name", ["y", "bucket"])
def test_keys_may_be_called_like_inner_columns(spark, name):
    sales = sales_frame(spark, rows(30)).where("date IS NOT NULL").select("date", "sales", F.col("store").alias(name))
    out = grouped_forecast(sales, [name], ForecastSpec(h=2), weekday_mean_model)
    assert out.columns == [name, "ds", "yhat", "yhat_lower", "yhat_upper"] and out.count() == 2 * sales.where("sales IS NOT NULL").select(name).distinct().count()
    walked = walk_forward(sales, [DAY + dt.timedelta(days=20)], [name])
    pairs = evaluate.with_actuals(walked, sales, [name])
    assert pairs.count() > 0 and pairs.columns == [*walked.columns, "_y" if name == "y" else "y"]


def test_coverage_counts_pairs_without_a_value(spark):
    pairs = spark.createDataFrame([(1, 5.0, 4.0, 3.0, 6.0), (1, None, 4.0, 3.0, 6.0), (1, 5.0, float("nan"), 3.0, 6.0)], "k INT, y DOUBLE, yhat DOUBLE, yhat_lower DOUBLE, yhat_upper DOUBLE")
    (r,) = evaluate.coverage_metrics(pairs, ["k"]).collect()
    assert (r["n"], r["n_null"], r["mse"]) == (3, 2, 1.0) and abs(r["accuracy"] - 2 / 3) < 1e-9


def test_changes_between_versions(spark, tmp_path):
    d = "2020-01-01"
    grown = [(d, 1, 1, 5, 0), (d, 1, 2, 6, 0), (d, 1, 3, 7, 1), (d, 1, 1, 5, 2), (d, 1, 2, 8, 2), (d, 1, 3, None, 3), (d, 1, 4, 1, 3), (None, 1, 5, 2, 3), (d, 1, 2, 6, 4)]
    df = spark.createDataFrame(grown, f"date STRING, store INT, item INT, sales BIGINT, {tables.VERSION} BIGINT")
    path = f"{tmp_path}/grown"
    tables.save(df, path, partition_by=[tables.VERSION])
    table = tables.read_table(spark, path)
    changes = lambda a, b: sorted((r["item"], r["change"], r["before"], r["after"]) for r in tables.version_changes(table, a, b).collect())
    assert changes(1, 3) == [(2, "changed", 6, 8), (3, "removed", 7, None), (4, "added", None, 1), (5, "added", None, 2)]
    assert changes(0, 4) == [(4, "added", None, 1), (5, "added", None, 2)]
    assert changes(2, 2) == []
    plan = tables.version_changes(table, 2, 3)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all(tables.VERSION in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in filters)
