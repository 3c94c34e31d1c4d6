"""Tasks by cost: one heavy series, several cutoffs."""

import datetime as dt
import statistics

import pandas as pd
from conftest import final_plan, tuples
from pyspark import TaskContext
from pyspark.sql import functions as F

from seriesmill.operators.forecast import ForecastSpec
from seriesmill.operators.grouped import grouped_forecast, weekday_mean_model
from seriesmill.operators.placement import cost_tasks, place_by_cost

START = dt.date(2001, 1, 1)


def heavy_and_light(spark):
    """1,000 days of one series, whose neighbours have 10 each."""
    days = spark.range(1000).withColumn("date", F.date_add(F.lit(START), F.col("id").cast("int")))
    heavy = days.select("date", F.lit(0).alias("store"), F.lit(1).cast("bigint").alias("sales"))
    light = days.where("id < 10").crossJoin(spark.range(1, 401).withColumnRenamed("id", "s"))
    return heavy.unionByName(light.select("date", F.col("s").cast("int").alias("store"), F.lit(1).cast("bigint").alias("sales")))


def test_no_task_has_twice_the_work_of_the_median(spark):
    def where_it_ran(history, days, spec):
        """The task as the forecast and the number of days as its upper bound."""
        return pd.DataFrame({"ds": days, "yhat": float(TaskContext.get().partitionId()), "yhat_lower": 0.0, "yhat_upper": float(len(history))})

    cutoffs = [START + dt.timedelta(1000 + k) for k in range(7)]
    spec = ForecastSpec(h=1, origin="cutoff")
    got = grouped_forecast(heavy_and_light(spark), ["store"], spec, where_it_ran, n_partitions=8, cutoffs=cutoffs, cost="n")
    work = {}
    for row in got.collect():
        work[row.yhat] = work.get(row.yhat, 0) + row.yhat_upper
    assert len(work) == 8 and sum(work.values()) == 7 * 5000
    assert max(work.values()) <= 2 * statistics.median(work.values())


def test_placement_changes_no_result_and_adds_no_shuffle_behind_it(spark):
    sales = heavy_and_light(spark).where("store < 20")
    spec = ForecastSpec(h=3)
    by_cost = grouped_forecast(sales, ["store"], spec, weekday_mean_model, n_partitions=5, cost="n * n")
    assert sorted(tuples(by_cost)) == sorted(tuples(grouped_forecast(sales, ["store"], spec, weekday_mean_model)))
    grouped = final_plan(by_cost).split("FlatMapGroupsInPandas")[1]
    assert grouped.index("shufflepartitionidpassthrough") < grouped.index("hashpartitioning")


def test_groups_without_key_or_cost_are_placed(spark):
    costs = spark.createDataFrame([(None, 1.0), ("a", None), ("b", -2.0)], "k STRING, cost DOUBLE")
    assert {k for k, _ in tuples(cost_tasks(costs, ["k"], 4))} == {None, "a", "b"}
    assert all(0 <= t < 4 for _, t in tuples(cost_tasks(costs, ["k"], 4)))
    assert {t for _, t in tuples(cost_tasks(costs.withColumn("cost", F.lit(0)), ["k"], 4))} == {0}
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k STRING, v INT")
    assert sorted(tuples(place_by_cost(rows, ["k"], 3).select("v"))) == [(1,), (2,), (3,)]
    assert tuples(place_by_cost(rows.limit(0), ["k"], 3)) == []
