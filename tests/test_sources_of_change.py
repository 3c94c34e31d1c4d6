"""Periods, representative copies and mergeable profiles against brute force."""

import datetime as dt
import random

import pytest
from conftest import final_plan, sales_frame, tuples
from pyspark.sql import functions as F

from seriesmill.operators.periods import Periods, count_periods, enrich_with_periods
from seriesmill.operators.profiles import drift, drift_alerts, merge_states, profile_state, state_metrics
from seriesmill.operators.quality import AlertRule
from seriesmill.operators.representative import representative_copy, representative_series, series_strata, stratum_report

DAY = dt.date(2001, 1, 1)


def periods_frame(spark, rows):
    return spark.createDataFrame(rows, "item INT, start DATE, end DATE, label STRING")


def random_sales(spark, chance, n=300):
    rows = [(str(DAY + dt.timedelta(chance.randrange(-30, 90))), chance.randrange(3), chance.choice([1, 1, 1, 2, 3]), n) for _ in range(n)]
    return rows, sales_frame(spark, rows)


@pytest.mark.parametrize("block_days", [1, 7, 400])
def test_overlapping_periods_are_counted_as_by_a_nested_loop(spark, block_days):
    chance = random.Random(block_days)
    rows, sales = random_sales(spark, chance)
    known = []
    for _ in range(40):
        start = DAY + dt.timedelta(chance.randrange(-40, 80))
        known.append((chance.choice([1, 2, None]), start, start + dt.timedelta(chance.choice([-1, 0, 3, 50])), None))
    got = count_periods(sales, Periods("p", periods_frame(spark, known), ("item",)), block_days)
    want = [(dt.date.fromisoformat(d), s, i, v, sum(k == i and a <= dt.date.fromisoformat(d) <= b for k, a, b, _ in known)) for d, s, i, v in rows]
    assert sorted(tuples(got)) == sorted(want)


def test_sales_get_the_period_that_holds(spark):
    sales = sales_frame(spark, [("2001-01-01", 1, 1, 5), ("2001-01-07", 1, 1, 6), ("2001-01-07", 1, 1, 6), ("2001-02-01", 1, 1, 7), ("2001-01-03", 1, 2, 8), (None, 1, 1, 9)])
    # The short period lies in the long one, where nothing was sold.
    known = [(1, DAY, dt.date(2001, 1, 20), "long"), (1, dt.date(2001, 1, 3), dt.date(2001, 1, 4), "short"), (2, None, DAY, "open")]
    got = enrich_with_periods(sales, Periods("promotion", periods_frame(spark, known), ("item",)))
    assert got.columns == ["date", "store", "item", "sales", "label", "has_promotion"]
    assert sorted(tuples(got.select("sales", "label", "has_promotion"))) == [
        (5, "long", True), (6, "long", True), (6, "long", True), (7, None, False), (8, None, False), (9, None, False)
    ]
    plan = final_plan(got)
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_two_periods_for_one_sale_fail_whatever_is_selected(spark):
    known = [(1, DAY, dt.date(2001, 1, 5), "a"), (1, dt.date(2001, 1, 3), dt.date(2001, 1, 9), "b")]
    got = enrich_with_periods(sales_frame(spark, [("2001-01-04", 1, 1, 5)]), Periods("p", periods_frame(spark, known), ("item",)))
    with pytest.raises(Exception, match="several periods of p"):
        got.select("label").collect()
    with pytest.raises(ValueError, match="label"):
        enrich_with_periods(got, Periods("q", periods_frame(spark, known), ("item",)))


def test_empty_sales_and_periods(spark):
    sales, none = sales_frame(spark, [("2001-01-01", 1, 1, 5)]), periods_frame(spark, [])
    assert tuples(enrich_with_periods(sales, Periods("p", none, ("item",))).select("label", "has_p")) == [(None, False)]
    assert tuples(count_periods(sales.limit(0), Periods("p", none, ("item",)))) == []


def test_strata_follow_volume_and_estimates_keep_their_bound(spark):
    chance = random.Random(3)
    rows = [("2001-01-01", s, i, int(10 ** (1 + 4 * chance.random()))) for s in range(20) for i in range(20)]
    sales = sales_frame(spark, rows + [("2001-01-01", 99, 99, None)])
    series = series_strata(sales, strata=5)
    chosen = representative_series(series, per_stratum=10)
    report = stratum_report(series, chosen).orderBy("stratum").collect()
    assert [r.stratum for r in report] == [0, 1, 2, 3, 4]
    assert sum(r.n_series for r in report) == 401 and all(60 <= r.n_series <= 100 and r.n_kept == 10 for r in report)
    assert all(abs(r.estimate - r.volume) <= r.bound for r in report)
    volumes = {}
    for r in series.collect():
        volumes.setdefault(r.stratum, []).append(r.volume)
    assert all(max(volumes[k]) < min(volumes[k + 1]) for k in range(4))
    copy = representative_copy(sales, chosen)
    assert copy.count() == 50 and copy.columns == sales.columns
    assert set(tuples(chosen)) == set(tuples(representative_series(series.repartition(7), per_stratum=10)))
    assert tuples(chosen) and set(tuples(chosen)) != set(tuples(representative_series(series, per_stratum=10, seed="b")))
    assert "WindowGroupLimit" in final_plan(chosen)  # tasks send no more than they may keep


def test_states_merge_to_the_profile_of_all_rows(spark):
    chance = random.Random(5)
    values = [chance.lognormvariate(3, 2) * chance.choice([1, -1]) for _ in range(4000)] + [0.0, float("nan"), float("inf"), None]
    rows = [(k % 5, v, f"t{k % 900}" if k % 10 else None) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "arrival_version BIGINT, x DOUBLE, t STRING")
    state = profile_state(df)
    merged = {(r.column, r.metric): r.value for r in state_metrics(merge_states(state)).collect()}
    whole = {(r.column, r.metric): r.value for r in state_metrics(profile_state(df.withColumn("arrival_version", F.lit(0)))).collect()}
    assert {k: v for k, v in merged.items() if k[1] != "distinct"} == {k: v for k, v in whole.items() if k[1] != "distinct"}
    finite = sorted(v for v in values if v is not None and abs(v) < float("inf"))
    assert merged["x", "rows"] == 4004 and merged["x", "null_share"] == 3 / 4004
    assert (merged["x", "min"], merged["x", "max"]) == (finite[0], finite[-1])
    for p, name in ((0.05, "p5"), (0.5, "p50"), (0.95, "p95")):
        exact = finite[int(p * (len(finite) - 1))]
        assert abs(merged["x", name] - exact) <= 0.0101 * abs(exact)
    for column, exact in (("x", len(set(finite))), ("t", len({t for _, _, t in rows} - {None}))):
        assert abs(merged[column, "distinct"] - exact) <= 0.05 * exact
    assert ("t", "p50") not in merged and ("t", "min") not in merged


def test_drift_reads_states_and_alerts_on_what_cannot_be_measured(spark):
    df = spark.createDataFrame([(0, 10), (0, 10), (1, 10), (1, 20), (1, None)], "arrival_version BIGINT, sales BIGINT")
    found = drift(profile_state(df), 1)
    changes = {r.metric: (r.before, r.after, r.change) for r in found.collect()}
    assert changes["max"] == (10.0, 20.0, 1.0) and changes["min"][2] == 0.0 and changes["null_share"][2] is None
    rules = [AlertRule("sales", "max", high=0.5), AlertRule("sales", "min", low=0, high=0), AlertRule("sales", "null_share", high=0)]
    assert {r.metric: r.breached for r in drift_alerts(found, rules).collect()} == {"max": True, "min": False, "null_share": True}
