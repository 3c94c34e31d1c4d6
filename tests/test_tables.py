"""Saved tables, versions, ledger, layers and the arrival stream."""

import datetime as dt
from dataclasses import replace

import pytest
from conftest import final_plan, sales_frame, tuples
from pyspark.sql import functions as F

from registry.spark_queries import CUT, QUERIES, holdout, train
from seriesmill import session
from seriesmill.plans import layers, walk_forward
from seriesmill.sources import tables
from seriesmill.sources.sales import daily_sales
from seriesmill.streaming import arrivals

D = dt.date


@pytest.fixture
def folder(spark):
    return session.shared_folder(spark, "test")


def test_shared_folder_follows_the_session_setting(spark):
    assert session.shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.shared_folder(spark, "x") != session.shared_folder(spark, "x")


def test_save_modes(spark, folder):
    one, two = sales_frame(spark, [("2020-01-01", 1, 1, 5)]), sales_frame(spark, [("2020-01-02", 1, 1, 6)])
    for target, options in ((f"{folder}/plain", {}), ("mode_table", {"path": f"{folder}/external"})):
        tables.save(one, target, **options)
        with pytest.raises(Exception, match="(?i)exist"):
            tables.save(two, target, **options)
        tables.save(two, target, mode="append", **options)
        assert tables.read_table(spark, target).count() == 2
        tables.save(two, target, mode="overwrite", **options)
        assert tuples(tables.read_table(spark, target)) == [(D(2020, 1, 2), 1, 1, 6)]
    tables.drop_table(spark, "mode_table")
    assert spark.read.parquet(f"{folder}/external").count() == 1  # an external table keeps its files


def test_database_and_managed_table_go_with_their_files(spark):
    tables.use_database(spark, "mill_test")
    tables.save(sales_frame(spark, [("2020-01-01", 1, 1, 5)]), "gone")
    location = spark.table("gone").inputFiles()[0]
    tables.drop_table(spark, "gone")
    tables.drop_table(spark, "gone")
    with pytest.raises(Exception):
        spark.read.parquet(location).collect()
    spark.sql("USE default")
    tables.drop_database(spark, "mill_test")
    assert not spark.catalog.databaseExists("mill_test")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_writing_a_partition_again_replaces_it_alone(spark, folder, kind):
    target = f"{folder}/by_day" if kind == "path" else "by_day_table"
    day = lambda d, n: sales_frame(spark, [(d, s, 1, n) for s in range(3)])
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for df in (day("2020-01-01", 1), day("2020-01-02", 2), day("2020-01-02", 3), day("2020-01-02", 3)):
        tables.save_partition(df, target, "date")
    out = tables.read_table(spark, target).groupBy("date").agg(F.count("*"), F.max("sales"))
    assert tuples(out, "date") == [(D(2020, 1, 1), 3, 1), (D(2020, 1, 2), 3, 3)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    tables.drop_table(spark, "by_day_table")


def test_read_table_sees_files_written_since(spark, folder):
    rows = sales_frame(spark, [("2020-01-01", 1, 1, 5)])
    tables.save(rows, f"{folder}/t")
    assert tables.read_table(spark, f"{folder}/t").count() == 1
    tables.save(rows, f"{folder}/t", mode="append")
    assert tables.read_table(spark, f"{folder}/t").count() == 2


def test_snapshot_prunes_partitions(spark, folder, small):
    versions = walk_forward.version_arrivals(daily_sales(spark, small), CUT)
    tables.save_partition(versions, f"{folder}/grown", tables.VERSION)
    old = tables.snapshot(tables.read_table(spark, f"{folder}/grown"), 0)
    assert "PartitionFilters: [isnotnull(arrival_version" in final_plan(old)
    assert old.count() == train(spark, small).count()


def test_ledger_is_repeatable(spark, folder, small):
    sales = daily_sales(spark, small, end="2001-10-03")
    cutoffs = ["2001-09-30", "2001-10-02"]
    params = walk_forward.run_parameters(walk_forward.NEXT_DAY)
    rows = walk_forward.ledger_rows(
        walk_forward.walk_forward(sales, cutoffs), walk_forward.version_arrivals(sales, CUT), cutoffs, params
    )
    for _ in range(2):
        walk_forward.append_runs(rows, f"{folder}/ledger")
    out = walk_forward.read_runs(spark, f"{folder}/ledger").orderBy("training_date").collect()
    assert [r["training_date"] for r in out] == [D(2001, 9, 30), D(2001, 10, 2)]
    assert len({r["run_id"] for r in out}) == 2 and out[0]["params"] == params and out[0]["data_version"] == 0
    other = walk_forward.ledger_rows(
        walk_forward.walk_forward(sales, cutoffs), walk_forward.version_arrivals(sales, CUT), cutoffs, {**params, "h": "2"}
    )
    assert not {r["run_id"] for r in other.collect()} & {r["run_id"] for r in out}


def test_layers(spark, folder):
    raw = sales_frame(
        spark,
        [("2020-01-01", 1, 1, 5), ("2020-01-01", 1, 1, 8), ("2020-01-02", 1, 1, -3), (None, 1, 1, 2), ("2020-02-01", 2, 1, 4)],
    ).withColumn("delivered", F.monotonically_increasing_id())
    paths = layers.build_layers(raw, folder, latest_by=["delivered"])
    read = lambda name: tables.read_table(spark, paths[name])
    assert tuples(read("clean"), "date") == [(D(2020, 1, 1), 1, 1, 8), (D(2020, 2, 1), 2, 1, 4)]
    assert sorted(r["_rule"] for r in read("quarantine").collect()) == ["low:sales", "not_null:date"]
    assert tuples(read("sales_by_year")) == [(2020, 12)]
    assert tuples(read("sales_by_month"), "month_start") == [(D(2020, 1, 1), 8), (D(2020, 2, 1), 4)]


def deliver(df, folder):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, **more):
    arrivals.run_arrivals(spark, f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint", **more)


def test_stream_takes_each_file_once_and_equals_the_batch(spark, folder, small):
    sales = holdout(spark, small)
    deliver(sales.where("date < '2001-10-15'"), folder)
    run(spark, folder)
    run(spark, folder)
    deliver(sales.where("date >= '2001-10-15'"), folder)
    run(spark, folder)
    landed = tables.read_table(spark, f"{folder}/table")
    assert tuples(tables.history(landed).select(tables.VERSION), tables.VERSION) == [(1,), (2,)]
    order = ["date", "store", "item"]
    assert tuples(arrivals.current_sales(spark, f"{folder}/table").select(sales.columns), *order) == tuples(sales, *order)


def test_corrected_delivery_wins(spark, folder):
    for value in (5, 9):
        deliver(sales_frame(spark, [("2020-01-01", 1, 1, value)]), folder)
        run(spark, folder)
    assert tuples(arrivals.current_sales(spark, f"{folder}/table")) == [(D(2020, 1, 1), 1, 1, 9)]


def test_stream_forecast_equals_walk_forward(spark, folder, small):
    arrivals.seed(train(spark, small), f"{folder}/table")
    deliver(holdout(spark, small).where("date <= '2001-10-04'"), folder)
    run(spark, folder, forecasts=f"{folder}/forecasts")
    out = tables.read_table(spark, f"{folder}/forecasts")
    days = [r[0] for r in holdout(spark, small).where("date <= '2001-10-04'").select("date").distinct().collect()]
    assert len(days) > 1 and {r[0] for r in out.select("training_date").distinct().collect()} == set(days)
    expected = walk_forward.walk_forward(daily_sales(spark, small, end="2001-10-05"), sorted(days))
    keys = ["training_date", "store", "item"]
    a, b = tuples(out.select(expected.columns), *keys), tuples(expected, *keys)
    assert len(a) == len(b) and all(x[:4] == y[:4] and abs(x[4] - y[4]) < 1e-9 for x, y in zip(a, b))


@pytest.mark.parametrize("name", ["idempotent_forecast_store", "arrival_history", "run_ledger"])
def test_table_queries_can_be_run_twice(spark, small, name):
    a, b = (sorted(map(str, QUERIES[name](spark, small).collect())) for _ in range(2))
    assert a == b


def test_a_new_checkpoint_writes_over_no_version(spark, folder, small):
    sales = holdout(spark, small)
    sales.where("date <= '2001-10-10'").write.parquet(f"{folder}/in")
    arrivals.run_arrivals(spark, f"{folder}/in", f"{folder}/table", f"{folder}/first")
    sales.where("date > '2001-10-10'").write.parquet(f"{folder}/more")
    arrivals.run_arrivals(spark, f"{folder}/more", f"{folder}/table", f"{folder}/second")
    assert sorted(map(tuple, arrivals.current_sales(spark, f"{folder}/table").collect())) == sorted(map(tuple, sales.collect()))


def test_arrivals_that_break_the_contract_are_set_aside(spark, folder):
    sales_frame(spark, [("2001-10-01", 1, 1, 5), (None, 1, 1, 7)]).write.parquet(f"{folder}/in")
    run(spark, folder)
    assert [r["sales"] for r in arrivals.current_sales(spark, f"{folder}/table").collect()] == [5]
    assert [(r["sales"], r["_rule"]) for r in tables.read_table(spark, f"{folder}/table_quarantine").collect()] == [(7, "not_null:date")]


def test_a_correction_counts_once_in_a_snapshot(spark):
    rows = [("2001-10-01", 1, 1, 5, 0), ("2001-10-02", 1, 1, 6, 1), ("2001-10-01", 1, 1, 9, 2), ("2001-10-02", 1, 1, 1, 3)]
    df = spark.createDataFrame(rows, f"date STRING, store INT, item INT, sales BIGINT, {tables.VERSION} BIGINT")
    assert {(r["date"], r["sales"]) for r in tables.snapshot(df, 2).collect()} == {("2001-10-01", 9), ("2001-10-02", 6)}
    assert tables.snapshot(df, 2).count() == 2


def test_run_parameters_tell_settings_keys_and_models_apart():
    spec = walk_forward.NEXT_DAY
    variants = [walk_forward.run_parameters(s, k, m) for s in (spec, replace(spec, weekly=False), replace(spec, yearly=False)) for k in (("store", "item"), ("item",)) for m in ("closed_form", "weekday_mean")]
    assert len({tuple(sorted(v.items())) for v in variants}) == 12


def test_discarded_tables_are_gone_and_others_stay(spark):
    import os

    one, two = (tables.materialise(spark.range(3), "scratch") for _ in range(2))
    path = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    first, second = path(one), path(two)
    view = tables.same_folder(one.where("id > 0"), one)
    assert view.count() == 2
    tables.discard(view, spark.range(2))
    assert not os.path.exists(first) and os.path.exists(second) and two.count() == 3
    tables.discard(one)  # already gone
