import datetime as dt

import pytest
from conftest import final_plan, sales_frame, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seriesmill.operators.quality import (
    AlertRule, Source, alerts, contract_violations, dedup, enforce, enrich, enrichment_coverage, profile, sample_series,
)
from seriesmill.sources.contract import SALES_CONTRACT, ColumnRule, Contract


def test_enforce_types_text_and_names_the_rule(spark):
    raw = spark.createDataFrame(
        [("2020-01-01", "1", "1", "5", "a"), ("2020-13-01", "1", "1", "5", "b"), ("2020-01-01", "0", "1", "5", "c"), ("2020-01-01", "1", None, "5", "d")],
        "date STRING, store STRING, item STRING, sales STRING, note STRING",
    )
    good, bad = enforce(raw, SALES_CONTRACT)
    assert tuples(good) == [(dt.date(2020, 1, 1), 1, 1, 5, "a")]
    assert dict(good.dtypes)["sales"] == "bigint"
    assert tuples(bad.select("note", "_rule"), "note") == [("b", "type:date"), ("c", "low:store"), ("d", "not_null:item")]


def test_enforce_splits_completely(spark):
    rows = [("2020-01-01" if n % 3 else None, n % 4, 1, n - 5) for n in range(50)]
    sales = sales_frame(spark, rows)
    good, bad = enforce(sales, SALES_CONTRACT)
    assert good.count() + bad.count() == 50


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)), min_size=1, max_size=40))
def test_dedup_keeps_one_greatest_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k INT, version INT, v INT")
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    expected = [max((r for r in rows if r[0] == k), key=order) for k in sorted({r[0] for r in rows})]
    assert tuples(dedup(df, ["k"], ["version"]), "k") == expected


def test_profile_counts(spark):
    sales = sales_frame(spark, [("2020-01-01", 1, 1, 5), ("2020-01-04", 1, 2, 7), (None, 1, 2, None)])
    found = {(r["column"], r["metric"]): r["value"] for r in profile(sales, {"mean": "avg(sales)"}).collect()}
    assert found[("*", "rows")] == 3 and found[("*", "mean")] == 6.0
    assert found[("date", "nulls")] == 1 and found[("date", "missing_days")] == 2
    assert (found[("item", "distinct")], found[("sales", "min")], found[("sales", "max")]) == (2, 5, 7)
    close = {(r["column"], r["metric"]): r["value"] for r in profile(sales, approximate=True).collect()}
    assert close[("item", "distinct")] == 2


def test_alerts_report_missing_metrics_as_breaches(spark):
    metrics = spark.createDataFrame([("sales", "max", 7.0), ("sales", "nulls", None)], "column STRING, metric STRING, value DOUBLE")
    rules = [AlertRule("sales", "max", high=7), AlertRule("sales", "max", low=8), AlertRule("sales", "nulls", high=0), AlertRule("x", "max", high=1)]
    out = {(r["column"], r["metric"], r["low"], r["high"]): r["breached"] for r in alerts(metrics, rules).collect()}
    assert list(out.values()).count(False) == 1 and out[("sales", "max", None, 7.0)] is False


def test_contract_violations_in_one_scan(spark):
    sales = sales_frame(spark, [("2020-01-01", 1, 1, 5), ("2020-01-01", 1, 1, 6), ("2020-01-02", 0, 1, -1), (None, 1, 1, 2)])
    contract = Contract((*SALES_CONTRACT.columns, ColumnRule("promo", "string")), SALES_CONTRACT.unique_key)
    out = {(r["rule"], r["column"]): r["n_bad"] for r in contract_violations(sales, contract).collect()}
    assert out[("missing", "promo")] == 4 and out[("unique", "date,store,item")] == 1
    assert out[("low", "store")] == 1 and out[("low", "sales")] == 1 and out[("not_null", "date")] == 1
    empty = contract_violations(sales.limit(0), SALES_CONTRACT)
    assert empty.where("n_bad <> 0").count() == 0 and empty.count() == 12


def test_sample_keeps_whole_series_without_a_shuffle(spark):
    rows = [("2020-01-0%d" % d, s, i, 1) for d in range(1, 6) for s in range(10) for i in range(10)]
    sales = sales_frame(spark, rows)
    parts = [sample_series(sales, ["store", "item"], 4, part) for part in range(4)]
    assert sum(p.count() for p in parts) == len(rows)
    assert all(r["count"] == 5 for r in parts[0].groupBy("store", "item").count().collect())
    assert "Exchange" not in final_plan(parts[0])


def test_enrich_keeps_every_row_and_reports_coverage(spark):
    sales = sales_frame(spark, [("2020-01-01", 1, 1, 5), ("2020-01-01", 2, 2, 6)])
    names = spark.createDataFrame([(1, "north")], "store INT, name STRING")
    days = spark.createDataFrame([(dt.date(2020, 1, 1), 3.5)], "date DATE, rain DOUBLE")
    out = enrich(sales, Source("names", names, ("store",)), Source("weather", days, ("date",)))
    assert tuples(out.select("store", "name", "has_names", "rain", "has_weather"), "store") == [
        (1, "north", True, 3.5, True), (2, None, False, 3.5, True)
    ]
    assert tuples(enrichment_coverage(out, ["names", "weather"]), "source") == [("names", 2, 1, 0.5), ("weather", 2, 2, 1.0)]


def test_enrich_refuses_a_source_with_two_rows_for_a_key(spark):
    sales = sales_frame(spark, [("2020-01-01", 1, 1, 5)])
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "store INT, name STRING")
    with pytest.raises(Exception, match="several rows"):
        enrich(sales, Source("names", twice, ("store",))).collect()


def test_enforcement_never_changes_a_value(spark):
    schema = "date TIMESTAMP, store STRING, item DOUBLE, sales DOUBLE"
    rows = [("2001-10-01 00:00:00", "1", 1.0, 3.0), ("2001-10-01 05:00:00", "1", 1.0, 3.0), ("2001-10-01 00:00:00", "1", 1.0, 3.7), ("2001-10-01 00:00:00", "1.5", 1.0, 3.0), (None, "1", 1.0, 3.0), ("2001-10-01 00:00:00", "0", 1.0, 3.0)]
    raw = spark.createDataFrame(rows, schema.replace("date TIMESTAMP", "date STRING")).selectExpr("CAST(date AS TIMESTAMP) AS date", "store", "item", "sales")
    good, bad = enforce(raw, SALES_CONTRACT)
    assert [tuple(r)[1:] for r in good.collect()] == [(1, 1, 3)]
    assert sorted(r["_rule"] for r in bad.collect()) == ["low:store", "not_null:date", "type:date", "type:sales", "type:store"]


def test_enrich_refuses_whatever_is_selected(spark):
    sales = spark.createDataFrame([("2001-10-01", 1, 1, 5)], "date STRING, store INT, item INT, sales BIGINT")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "store INT, name STRING")
    with pytest.raises(Exception, match="several rows"):
        enrich(sales, Source("names", twice, ("store",))).select("store", "name", "sales").collect()
