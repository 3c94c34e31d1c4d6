"""What the physical plans must look like."""

import re

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from registry.oracle import ORACLE
from registry.spark_queries import CUT, QUERIES, train
from seriesmill.operators import explore
from seriesmill.operators.forecast import forecast
from seriesmill.plans import layers
from seriesmill.sources.sales import daily_sales


def n(pattern, plan):
    return len(re.findall(pattern, plan))


@pytest.fixture(scope="module")
def plan_of(spark, small):
    seen = {}

    def get(name):
        if name not in seen:
            seen[name] = final_plan(QUERIES[name](spark, small))
        return seen[name]

    return get


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_native_forecast_shuffles_twice_and_runs_no_python(plan_of):
    plan = plan_of("series_forecast")
    assert n("Exchange hashpartitioning", plan) == 2  # daily totals, then series
    assert n("FileScan", plan) == 1
    # Daily rows are sorted once; the other two sorts see the cells, 84 rows per series at most.
    below_cells = plan[plan.rindex("partial_covar_pop"):]
    assert n(r"\bSort ", below_cells) == 1 and n(r"\bSort ", plan) == 3
    assert n(r"\bWindow ", below_cells) == 1
    assert not n("Python|Pandas", plan)


def test_cutoffs_do_not_multiply_the_shuffle(plan_of):
    plan = plan_of("walk_forward_forecast")
    assert n("Exchange hashpartitioning", plan) == 2 and n("FileScan", plan) == 1
    # Plans print the last operator first: rows multiply after the shuffle and the sort by series.
    before = plan[plan.index("Generate inline"):]
    assert "REPARTITION_BY_NUM" in before and n(r"\bSort ", before) == 1
    assert "training_date" not in before[before.index("REPARTITION_BY_NUM"):]


def test_bucketed_table_needs_no_shuffle_at_all(plan_of):
    assert "Exchange" not in plan_of("bucketed_series_forecast")


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = daily_sales(spark, small, start=CUT)
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,2001-10-01T00:00)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_key_filter_is_applied_before_the_first_shuffle(spark, small):
    plan = final_plan(forecast(train(spark, small), where="store = 1 AND item = 1"))
    scan_side = plan[plan.rindex("Exchange"):]
    assert "% 5" in scan_side and "Filter" in scan_side


@pytest.mark.parametrize("name", ["series_metrics", "strategy_comparison", "coverage_overall", "walk_forward_metrics"])
def test_scoring_is_native(plan_of, name):
    assert not n("Python|Pandas", plan_of(name))


@pytest.mark.parametrize("name", ["prediction_overview", "strategy_comparison", "walk_forward_actuals", "allocated_forecast", "enriched_sales"])
def test_no_cross_or_nested_loop_join(plan_of, name):
    assert not n("NestedLoop|Cartesian", plan_of(name))


def test_unmatched_allocations_are_pruned_from_the_comparison(plan_of):
    assert "Union" in plan_of("allocated_forecast") and "LeftAnti" in plan_of("allocated_forecast")
    assert "Union" not in plan_of("prediction_overview") and "LeftAnti" not in plan_of("prediction_overview")


def test_grouped_map_reuses_its_one_spread_by_series(plan_of):
    plan = plan_of("grouped_map_forecast")
    assert n("Exchange hashpartitioning", plan) == 2 and n("REPARTITION_BY_NUM", plan) == 1
    assert n("Python|Pandas", plan) == 1


def test_raw_lines_are_scanned_once_per_comparison(plan_of):
    for name in ("prediction_overview", "coverage_overall", "allocated_forecast"):
        assert "l_shipdate" not in plan_of(name)


def test_layers_without_corrections_equal_the_plain_aggregates(spark, small, tmp_path):
    sales = daily_sales(spark, small).withColumn("v", F.lit(0))
    paths = layers.build_layers(sales, str(tmp_path), latest_by=["v"])
    by_month = sorted(map(tuple, spark.read.parquet(paths["sales_by_month"]).collect()))
    assert by_month == sorted(map(tuple, explore.sales_by_month(daily_sales(spark, small)).collect()))
