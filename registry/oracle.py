"""The same results as plain SQL, one text per registered query.

Written with joins and grouped subqueries throughout, unlike the library, so that a mistake in one
form is unlikely to be repeated in the other.
"""

from __future__ import annotations

from statistics import NormalDist

import pyspark

CUT = "DATE '2001-10-01'"
Z = repr(NormalDist().inv_cdf(0.975))


def sales(name: str = "sales", where: str = "true", n_stores: int = 5, n_items: int = 10) -> str:
    return f"""{name} AS (
        SELECT * FROM (
            SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % {n_stores} + 1 AS INTEGER) AS store,
                   CAST(l_partkey % {n_items} + 1 AS INTEGER) AS item, CAST(sum(l_quantity) AS BIGINT) AS sales
            FROM lineitem GROUP BY 1, 2, 3
        ) WHERE {where})"""


TRAIN = sales("train", f"date < {CUT}")
HOLDOUT = sales("holdout", f"date >= {CUT}")


def r(expression: str, alias: str) -> str:
    return f"round({expression}, 4) + 0.0 AS {alias}"


def bounds(prefix: str = "") -> str:
    return ", ".join(r(f"{prefix}{c}", c) for c in ("yhat", "yhat_lower", "yhat_upper"))


def model(obs: str, keys: str, p: str, days: str) -> str:
    """CTEs of the closed-form forecast over ``obs`` (keys, ds, y); the last one is ``{p}fc``.

    ``days`` is the select list item that yields the days to predict from the series line.
    """
    return f"""
    {p}line AS (
        SELECT {keys}, max(ds) AS last_ds,
               CASE WHEN count(DISTINCT ds) < 2 THEN 0.0 ELSE regr_slope(y, t) END AS b,
               CASE WHEN count(DISTINCT ds) < 2 THEN avg(y) ELSE regr_intercept(y, t) END AS a,
               0.01 * abs(avg(y)) AS low
        FROM (SELECT *, date_diff('day', DATE '1995-01-01', ds) AS t FROM {obs}) GROUP BY {keys}),
    {p}tr AS (
        SELECT o.*, dayofweek(ds) AS wd, month(ds) AS mo,
               greatest(a + b * date_diff('day', DATE '1995-01-01', ds), low) AS trend
        FROM {obs} o JOIN {p}line USING ({keys})),
    {p}wk AS (SELECT {keys}, wd, greatest(coalesce(sum(y) / nullif(sum(trend), 0), 1.0), 0.001) AS wi FROM {p}tr GROUP BY {keys}, wd),
    {p}yr AS (
        SELECT {keys}, mo, coalesce(sum(y) / nullif(sum(trend * wi), 0), 1.0) AS yi
        FROM {p}tr JOIN {p}wk USING ({keys}, wd) GROUP BY {keys}, mo),
    {p}sd AS (
        SELECT {keys}, stddev_samp(y - trend * wi * yi) AS sd
        FROM {p}tr JOIN {p}wk USING ({keys}, wd) JOIN {p}yr USING ({keys}, mo) GROUP BY {keys}),
    {p}days AS (SELECT {keys}, a, b, low, {days} AS ds FROM {p}line),
    {p}parts AS (
        SELECT *, dayofweek(ds) AS wd, month(ds) AS mo,
               greatest(a + b * date_diff('day', DATE '1995-01-01', ds), low) AS trend FROM {p}days),
    {p}fc AS (
        SELECT *, yhat - {Z} * sd AS yhat_lower, yhat + {Z} * sd AS yhat_upper FROM (
            SELECT {keys}, ds, trend, coalesce(wi, 1.0) AS weekly, coalesce(yi, 1.0) AS yearly, sd,
                   trend * coalesce(wi, 1.0) * coalesce(yi, 1.0) AS yhat
            FROM {p}parts LEFT JOIN {p}wk USING ({keys}, wd) LEFT JOIN {p}yr USING ({keys}, mo)
            LEFT JOIN {p}sd USING ({keys})))"""


def ahead(column: str, h: int) -> str:
    return (
        f"CAST(unnest(generate_series({column} + INTERVAL 1 DAY, {column} + INTERVAL {h} DAY, INTERVAL 1 DAY)) AS DATE)"
    )


OBS = "obs AS (SELECT store, item, date AS ds, CAST(sales AS DOUBLE) AS y FROM train)"
ITEM_OBS = "iobs AS (SELECT item, date AS ds, CAST(sum(sales) AS DOUBLE) AS y FROM train GROUP BY item, date)"
SERIES = f"{TRAIN}, {OBS}, {model('obs', 'store, item', 's_', ahead('last_ds', 30))}"
ITEMS = f"{ITEM_OBS}, {model('iobs', 'item', 'i_', ahead('last_ds', 30))}"
SHARE = """share AS (
        SELECT item, store, store_item_sales / item_sales AS ratio, store_item_sales, item_sales
        FROM (SELECT item, store, CAST(sum(sales) AS BIGINT) AS store_item_sales FROM train GROUP BY item, store)
        JOIN (SELECT item, CAST(sum(sales) AS BIGINT) AS item_sales FROM train GROUP BY item) USING (item))"""
ALLOCATED = f"""{ITEMS}, {SHARE}, alloc AS (
        SELECT store, item, ds, yhat * ratio AS yhat FROM i_fc FULL OUTER JOIN share USING (item))"""
OVERVIEW = f"""{SERIES}, {ALLOCATED}, {HOLDOUT}, aligned AS (
        SELECT date, store, item, max(y) AS y, max(own) AS yhat, max(lo) AS yhat_lower, max(hi) AS yhat_upper, max(top) AS yhat_agg
        FROM (
            SELECT date, store, item, 1 AS source, sales AS y, NULL AS own, NULL AS lo, NULL AS hi, NULL AS top FROM holdout
            UNION ALL SELECT ds, store, item, 2, NULL, yhat, yhat_lower, yhat_upper, NULL FROM s_fc
            UNION ALL SELECT ds, store, item, 3, NULL, NULL, NULL, NULL, yhat FROM alloc)
        GROUP BY date, store, item HAVING count(DISTINCT source) = 3),
    overview AS (
        SELECT *, yhat - yhat_agg AS pred_diff, y - yhat AS miss, y - yhat_agg AS agg_miss FROM aligned)"""
OVERVIEW_ROWS = f"""SELECT date, store, item, y, {bounds()}, {r('yhat_agg', 'yhat_agg')},
        {r('pred_diff', 'pred_diff')}, {r('miss', 'miss')}, {r('agg_miss', 'agg_miss')} FROM overview"""
STACKED = f"""{OVERVIEW}, stacked AS (
        SELECT store, item, y, yhat, 'store_item' AS model FROM overview UNION ALL
        SELECT store, item, y, yhat_agg, 'allocated' FROM overview),
    metrics AS (
        SELECT store, item, model, count(*) AS n, CAST(0 AS BIGINT) AS n_null, avg((y - yhat) ** 2) AS mse,
               sqrt(avg((y - yhat) ** 2)) AS rmse, avg(abs(y - yhat)) AS mae
        FROM stacked GROUP BY store, item, model)"""
METRICS = f"store, item, n, n_null, {r('mse', 'mse')}, {r('rmse', 'rmse')}, {r('mae', 'mae')}, model"
CHAMPION = "SELECT store, item, arg_min(model, (rmse, model)) AS model, min(rmse) AS rmse FROM metrics GROUP BY store, item"


def cutoffs(first: str, last: str) -> str:
    return f"""cut AS (
        SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS training_date)"""


def walk(first: str, last: str) -> str:
    return f"""{sales()}, {cutoffs(first, last)}, wobs AS (
        SELECT training_date, store, item, date AS ds, CAST(sales AS DOUBLE) AS y
        FROM sales JOIN cut ON date <= training_date),
    {model('wobs', 'training_date, store, item', 'w_', 'CAST(training_date + INTERVAL 1 DAY AS DATE)')}"""


WALK = walk("2001-09-30", "2001-10-06")
#: Every day that has sales from the cut on is a training date.
DELIVERED = walk("2001-10-01", "2001-10-06").replace(
    cutoffs("2001-10-01", "2001-10-06"), f"cut AS (SELECT DISTINCT date AS training_date FROM sales WHERE date >= {CUT})"
)
WALK_ROWS = f"SELECT training_date, store, item, ds, {bounds()} FROM w_fc"
PAIRS = f"""{WALK}, pairs AS (
        SELECT f.training_date, f.store, f.item, f.ds, f.yhat, f.yhat_lower, f.yhat_upper, s.sales AS y
        FROM w_fc f JOIN sales s ON f.ds = s.date AND f.store = s.store AND f.item = s.item)"""
COVERAGE = f"""count(*) AS n, count(*) FILTER (WHERE y IS NULL OR yhat IS NULL) AS n_null, {r('avg((y - yhat) ** 2)', 'mse')}, {r('sqrt(avg((y - yhat) ** 2))', 'rmse')},
       {r('avg(abs(y - yhat))', 'mae')},
       {r('avg(CASE WHEN yhat_lower < y AND y < yhat_upper THEN 1.0 ELSE 0.0 END)', 'accuracy')},
       {r('avg(CASE WHEN y < yhat_upper THEN 1.0 ELSE 0.0 END)', 'stocked')}"""

ONE_SERIES = f"""{TRAIN}, obs AS (
        SELECT store, item, date AS ds, CAST(sales AS DOUBLE) AS y FROM train WHERE store = 1 AND item = 1),
    {model('obs', 'store, item', 's_', ahead('last_ds', 90)).replace(
        's_days AS (', 's_days AS (SELECT store, item, a, b, low, ds FROM obs JOIN s_line USING (store, item) UNION ALL ')}"""
ALL_SERIES_90 = f"""{TRAIN}, {OBS},
    {model('obs', 'store, item', 's_', ahead('last_ds', 90)).replace(
        's_days AS (', 's_days AS (SELECT store, item, a, b, low, ds FROM obs JOIN s_line USING (store, item) UNION ALL ')}"""

GROWN = f"""{sales('grown_sales', "date < DATE '2001-10-07'")}, grown AS (
        SELECT *, CAST(CASE WHEN date < {CUT} THEN 0 ELSE date_diff('day', {CUT}, date) + 1 END AS BIGINT)
                  AS arrival_version FROM grown_sales)"""
LINES = """lines AS (
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 5 + 1 AS INTEGER) AS store,
               CAST(l_partkey % 10 + 1 AS INTEGER) AS item, CAST(l_quantity AS BIGINT) AS sales,
               l_orderkey, l_linenumber FROM lineitem)"""
#: Item 1 was delivered again with one unit more per row.
CORRECTED = f"""{sales('delivered')}, newest AS (
        SELECT date, store, item, CASE WHEN item = 1 THEN sales + 1 ELSE sales END AS sales FROM delivered)"""


def weekday_mean(obs: str, keys: str, days: str) -> str:
    return f"""
    mean_all AS (SELECT {keys}, avg(y) AS m, max(ds) AS last_ds FROM {obs} GROUP BY {keys}),
    mean_wd AS (SELECT {keys}, dayofweek(ds) AS wd, avg(y) AS wm FROM {obs} GROUP BY {keys}, dayofweek(ds)),
    spread AS (
        SELECT {keys}, stddev_samp(y - wm) AS sd
        FROM (SELECT *, dayofweek(ds) AS wd FROM {obs}) JOIN mean_wd USING ({keys}, wd) GROUP BY {keys}),
    fc AS (
        SELECT *, yhat - {Z} * sd AS yhat_lower, yhat + {Z} * sd AS yhat_upper FROM (
            SELECT {keys}, ds, coalesce(wm, m) AS yhat, sd
            FROM (SELECT *, dayofweek(ds) AS wd FROM (SELECT {keys}, m, {days} AS ds FROM mean_all))
            LEFT JOIN mean_wd USING ({keys}, wd) LEFT JOIN spread USING ({keys})))"""


PROFILE = f"""{sales()}, facts AS (
        SELECT count(*) AS n,
               count(*) - count(date) AS dn, count(DISTINCT date) AS dd,
               date_diff('day', DATE '1970-01-01', min(date)) AS d0, date_diff('day', DATE '1970-01-01', max(date)) AS d1,
               count(*) - count(store) AS sn, count(DISTINCT store) AS sd, min(store) AS s0, max(store) AS s1,
               count(*) - count(item) AS inul, count(DISTINCT item) AS idis, min(item) AS i0, max(item) AS i1,
               count(*) - count(sales) AS xn, count(DISTINCT sales) AS xd, min(sales) AS x0, max(sales) AS x1,
               avg(sales) AS mean_sales FROM sales),
    profile AS (
        SELECT '*' AS "column", 'rows' AS metric, CAST(n AS DOUBLE) AS value FROM facts
        UNION ALL SELECT 'date', 'nulls', dn FROM facts UNION ALL SELECT 'date', 'distinct', dd FROM facts
        UNION ALL SELECT 'date', 'min', d0 FROM facts UNION ALL SELECT 'date', 'max', d1 FROM facts
        UNION ALL SELECT 'date', 'missing_days', d1 - d0 + 1 - dd FROM facts
        UNION ALL SELECT 'store', 'nulls', sn FROM facts UNION ALL SELECT 'store', 'distinct', sd FROM facts
        UNION ALL SELECT 'store', 'min', s0 FROM facts UNION ALL SELECT 'store', 'max', s1 FROM facts
        UNION ALL SELECT 'item', 'nulls', inul FROM facts UNION ALL SELECT 'item', 'distinct', idis FROM facts
        UNION ALL SELECT 'item', 'min', i0 FROM facts UNION ALL SELECT 'item', 'max', i1 FROM facts
        UNION ALL SELECT 'sales', 'nulls', xn FROM facts UNION ALL SELECT 'sales', 'distinct', xd FROM facts
        UNION ALL SELECT 'sales', 'min', x0 FROM facts UNION ALL SELECT 'sales', 'max', x1 FROM facts
        UNION ALL SELECT '*', 'mean_sales', mean_sales FROM facts)"""

ENRICHED = f"""{sales()}, by_item AS (
        SELECT CAST(p_partkey % 10 + 1 AS INTEGER) AS item, count(*) AS n_parts, avg(p_retailprice) AS mean_price
        FROM part GROUP BY 1),
    by_store AS (
        SELECT CAST(s_suppkey % 5 + 1 AS INTEGER) AS store, count(*) AS n_suppliers,
               count(DISTINCT n_regionkey) AS n_regions
        FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
    by_day AS (
        SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n_orders,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS n_filled FROM orders GROUP BY 1),
    enriched AS (
        SELECT s.*, n_parts, mean_price, i.item IS NOT NULL AS has_part, n_suppliers, n_regions,
               t.store IS NOT NULL AS has_supplier, n_orders, n_filled, d.date IS NOT NULL AS has_orders
        FROM sales s LEFT JOIN by_item i ON s.item = i.item LEFT JOIN by_store t ON s.store = t.store
        LEFT JOIN by_day d ON s.date = d.date)"""


def xxhash_step(source: str, column: str, seed: str, out: str) -> str:
    """CTEs that add ``out``, the public 64-bit xxHash of a 4-byte integer column, as an unsigned number."""
    wrap = "CAST(18446744073709551616 AS UHUGEINT)"
    p1, p2, p3, p5 = (
        f"CAST({n} AS UHUGEINT)"
        for n in (11400714785074694791, 14029467366897019727, 1609587929392839161, 2870177450012600261)
    )

    def shifted(x: str, bits: int) -> str:
        return f"xor({x}, {x} // CAST({2**bits} AS UHUGEINT))"

    return f"""
    {out}_a AS (SELECT *, xor(({seed} + {p5} + 4) % {wrap}, CAST({column} AS UHUGEINT) * {p1} % {wrap}) AS h FROM {source}),
    {out}_b AS (SELECT * EXCLUDE (h), (h * CAST({2**23} AS UHUGEINT) % {wrap} + h // CAST({2**41} AS UHUGEINT)) AS h FROM {out}_a),
    {out}_c AS (SELECT * EXCLUDE (h), (h * {p2} % {wrap} + {p3}) % {wrap} AS h FROM {out}_b),
    {out}_d AS (SELECT * EXCLUDE (h), {shifted('h', 33)} * {p2} % {wrap} AS h FROM {out}_c),
    {out}_e AS (SELECT * EXCLUDE (h), {shifted('h', 29)} * {p3} % {wrap} AS h FROM {out}_d),
    {out} AS (SELECT * EXCLUDE (h), {shifted('h', 32)} AS {out}_hash FROM {out}_e)"""


RULES = """(VALUES ('*', 'rows', CAST(1 AS DOUBLE), CAST(NULL AS DOUBLE)), ('sales', 'max', NULL, 100),
        ('sales', 'nulls', NULL, 0), ('date', 'missing_days', NULL, 0), ('*', 'mean_sales', 10, 1000))
        AS rules("column", metric, low, high)"""

MONTHLY = "SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, {by} CAST(sum(sales) AS BIGINT) AS sales FROM sales {where} GROUP BY ALL"

PARAM_VALUES = {
    "h": "1", "include_history": "False", "keys": "store,item", "level": "0.95", "library": f"pyspark {pyspark.__version__}",
    "mode": "multiplicative", "model": "closed_form", "origin": "cutoff", "weekly": "True", "yearly": "True",
}
PARAMS = "|".join(f"{name}={value}" for name, value in PARAM_VALUES.items())
PARAM_COLUMNS = ", ".join(f"'{value}' AS param_{name}" for name, value in PARAM_VALUES.items())

ORACLE: dict[str, str] = {
    "sales_by_year": f"WITH {sales()} SELECT CAST(year(date) AS INTEGER) AS year, CAST(sum(sales) AS BIGINT) AS sales FROM sales GROUP BY 1",
    "sales_by_month": f"WITH {sales()} {MONTHLY.format(by='', where='')}",
    "weekday_profile": f"""WITH {sales()}, daily AS (SELECT date, sum(sales) AS sales FROM sales GROUP BY date)
        SELECT CAST(year(date) AS INTEGER) AS year, CAST((dayofweek(date) + 1) % 7 AS INTEGER) AS weekday,
               {r('avg(sales)', 'sales')} FROM daily GROUP BY 1, 2""",
    "store_month_profile": f"""WITH {sales()}, monthly AS ({MONTHLY.format(by='store,', where='')})
        SELECT CAST(month(month_start) AS INTEGER) AS month, store, {r('avg(sales)', 'sales')} FROM monthly GROUP BY 1, 2""",
    "item_month_profile": f"""WITH {sales()}, monthly AS ({MONTHLY.format(by='store,', where='WHERE item = 1')})
        SELECT CAST(month(month_start) AS INTEGER) AS month, store, {r('avg(sales)', 'sales')} FROM monthly GROUP BY 1, 2""",
    "item_all_month_profile": f"""WITH {sales()}, monthly AS ({MONTHLY.format(by='item, store,', where='')})
        SELECT CAST(month(month_start) AS INTEGER) AS month, item, store, {r('avg(sales)', 'sales')}
        FROM monthly GROUP BY 1, 2, 3""",
    "max_date": f"WITH {sales()} SELECT max(date) AS max_date FROM sales",
    "split_summary": f"""WITH {sales()} SELECT count(*) AS n_total, count(*) FILTER (WHERE date < {CUT}) AS n_train,
        count(*) FILTER (WHERE date >= {CUT}) AS n_test, count(*) FILTER (WHERE date IS NULL) AS n_null_date,
        {r(f'100.0 * count(*) FILTER (WHERE date < {CUT}) / CAST(count(*) AS DOUBLE)', 'train_pct')} FROM sales""",
    "series_list": f"WITH {sales()} SELECT DISTINCT store, item FROM sales",
    "train_sales": f"WITH {sales()} SELECT * FROM sales WHERE date < {CUT}",
    "holdout_sales": f"WITH {sales()} SELECT * FROM sales WHERE date >= {CUT}",
    "sales_preview": f"WITH {sales()} SELECT * FROM sales ORDER BY date, store, item LIMIT 10",
    "series_forecast": f"WITH {SERIES} SELECT store, item, ds, {bounds()} FROM s_fc",
    "series_forecast_500": f"""WITH {sales('train', f'date < {CUT}', 10, 50)}, {OBS},
        {model('obs', 'store, item', 's_', ahead('last_ds', 30))} SELECT store, item, ds, {bounds()} FROM s_fc""",
    "bucketed_series_forecast": f"WITH {SERIES} SELECT store, item, ds, {bounds()} FROM s_fc",
    "forecast_components": f"""WITH {SERIES} SELECT store, item, ds, {r('trend', 'trend')}, {r('weekly', 'weekly')},
        {r('yearly', 'yearly')}, {r('yhat', 'yhat')} FROM s_fc""",
    "single_series_forecast": f"WITH {ONE_SERIES} SELECT store, item, ds, {bounds()} FROM s_fc",
    "single_series_fit_metrics": f"""WITH {ONE_SERIES}, pairs AS (
        SELECT f.yhat, o.y FROM s_fc f JOIN obs o ON f.ds = o.ds WHERE f.ds < {CUT})
        SELECT {r('avg(abs(y - yhat))', 'mae')}, {r('avg((y - yhat) ** 2)', 'mse')},
               {r('sqrt(avg((y - yhat) ** 2))', 'rmse')} FROM pairs""",
    "actual_vs_forecast_slice": f"""WITH {ALL_SERIES_90}
        SELECT f.store, f.item, f.ds, CAST(o.y AS BIGINT) AS y, {bounds('f.')}
        FROM s_fc f JOIN s_line l ON f.store = l.store AND f.item = l.item
        LEFT JOIN obs o ON f.store = o.store AND f.item = o.item AND f.ds = o.ds
        WHERE date_diff('day', f.ds, l.last_ds) < 365""",
    "item_daily_sales": f"WITH {TRAIN} SELECT item, date, CAST(sum(sales) AS BIGINT) AS sales FROM train GROUP BY 1, 2",
    "store_item_share": f"WITH {TRAIN}, {SHARE} SELECT item, store, {r('ratio', 'ratio')}, store_item_sales, item_sales FROM share",
    "item_forecast": f"WITH {TRAIN}, {ITEMS} SELECT item, ds, {bounds()} FROM i_fc",
    "allocated_forecast": f"WITH {TRAIN}, {ALLOCATED} SELECT store, item, ds, {r('yhat', 'yhat')} FROM alloc",
    "prediction_overview": f"WITH {OVERVIEW} {OVERVIEW_ROWS}",
    "overview_of_one_item": f"WITH {OVERVIEW} {OVERVIEW_ROWS} WHERE item = 1",
    "series_metrics": f"WITH {STACKED} SELECT {METRICS} FROM metrics WHERE model = 'store_item'",
    "allocation_metrics": f"WITH {STACKED} SELECT {METRICS} FROM metrics WHERE model = 'allocated'",
    "strategy_comparison": f"WITH {STACKED} SELECT {METRICS} FROM metrics",
    "champion_model": f"WITH {STACKED} SELECT store, item, model, {r('rmse', 'rmse')} FROM ({CHAMPION})",
    "strategy_wins": f"WITH {STACKED} SELECT model, count(*) AS n_series FROM ({CHAMPION}) GROUP BY model",
    "miss_by_store": f"WITH {OVERVIEW} SELECT store, {r('sum(miss)', 'miss')}, {r('sum(agg_miss)', 'agg_miss')} FROM overview GROUP BY store",
    "miss_by_item": f"WITH {OVERVIEW} SELECT item, {r('sum(miss)', 'miss')}, {r('sum(agg_miss)', 'agg_miss')} FROM overview GROUP BY item",
    "unscored_sales": f"""WITH {SERIES}, {HOLDOUT} SELECT * FROM holdout t WHERE NOT EXISTS (
        SELECT 1 FROM s_fc f WHERE f.store = t.store AND f.item = t.item AND f.ds = t.date)""",
    "walk_forward_forecast": f"WITH {WALK} {WALK_ROWS}",
    "walk_forward_actuals": f"WITH {PAIRS} SELECT training_date, store, item, ds, {bounds()}, y FROM pairs",
    "walk_forward_metrics": f"WITH {PAIRS} SELECT store, item, {COVERAGE}, 'store_item' AS model FROM pairs GROUP BY store, item",
    "coverage_by_cutoff": f"WITH {PAIRS} SELECT training_date, {COVERAGE} FROM pairs GROUP BY training_date",
    "coverage_overall": f"WITH {PAIRS} SELECT accuracy, stocked FROM (SELECT {COVERAGE} FROM pairs)",
    "saved_once_sales": f"WITH {sales()} SELECT * FROM sales",
    "database_sales": f"WITH {sales()} SELECT * FROM sales",
    "catalog_table_sales": f"WITH {sales()} SELECT * FROM sales",
    "arrival_history": f"""WITH {GROWN} SELECT arrival_version, count(*) AS n_rows, min(date) AS min_date,
        max(date) AS max_date FROM grown GROUP BY arrival_version""",
    "latest_arrival": f"WITH {GROWN} SELECT max(arrival_version) AS arrival_version FROM grown",
    "snapshot_sales": f"WITH {GROWN} SELECT date, store, item, sales FROM grown WHERE arrival_version <= 3",
    "run_ledger": f"""WITH {WALK}, {GROWN}, sizes AS (
            SELECT training_date, count(DISTINCT (store, item)) AS n_series, count(*) AS n_rows FROM w_fc GROUP BY 1),
        seen AS (
            SELECT training_date, max(arrival_version) AS data_version
            FROM cut JOIN grown ON date <= training_date GROUP BY 1)
        SELECT sha256(strftime(training_date, '%Y-%m-%d') || '|' || data_version || '|{PARAMS}') AS run_id,
               training_date, data_version, {PARAM_COLUMNS}, n_series, n_rows FROM sizes JOIN seen USING (training_date)""",
    "idempotent_forecast_store": f"WITH {WALK} {WALK_ROWS}",
    "csv_sales": f"WITH {sales()} SELECT * FROM sales",
    "csv_quarantined_sales": f"""WITH {sales()} SELECT strftime(date, '%Y-%m-%d') || ',' || store || ',' || item || ',' ||
        sales || ' units' AS raw_text, 'malformed' AS rule FROM sales WHERE date >= {CUT}""",
    "enforced_sales": f"WITH {sales()} SELECT * FROM sales WHERE sales <= 100",
    "quarantined_sales": f"WITH {sales()} SELECT *, 'high:sales' AS rule FROM sales WHERE sales > 100",
    "deduplicated_sales": f"WITH {CORRECTED} SELECT * FROM newest",
    "quality_profile": f"""WITH {PROFILE} SELECT "column", metric, {r('value', 'value')} FROM profile""",
    "quality_alerts": f"""WITH {PROFILE} SELECT "column", metric, {r('value', 'value')}, low, high,
        NOT (coalesce(value >= low, true) AND coalesce(value <= high, true)) AS breached
        FROM {RULES} LEFT JOIN profile USING ("column", metric)""",
    "contract_violations": f"""WITH {LINES}, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE sales > 100) AS high,
            (SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM lines GROUP BY date, store, item)) AS extra FROM lines)
        SELECT rule, "column", CAST(n_bad AS BIGINT) AS n_bad FROM (
            SELECT 'missing' AS rule, 'promotion' AS "column", total AS n_bad FROM n
            UNION ALL SELECT 'type', c, 0 FROM (VALUES ('date'), ('store'), ('item'), ('sales')) v(c)
            UNION ALL SELECT 'not_null', c, 0 FROM (VALUES ('date'), ('store'), ('item'), ('sales')) v(c)
            UNION ALL SELECT 'low', c, 0 FROM (VALUES ('store'), ('item'), ('sales')) v(c)
            UNION ALL SELECT 'high', 'sales', high FROM n
            UNION ALL SELECT 'unique', 'date,store,item', extra FROM n)""",
    "series_sample": f"""WITH {sales()}, {xxhash_step('sales', 'store', 'CAST(42 AS UHUGEINT)', 'first')},
        {xxhash_step('first', 'item', 'first_hash', 'second')}
        SELECT date, store, item, sales FROM second WHERE second_hash % 4 = 0""",
    "enriched_sales": f"WITH {ENRICHED} SELECT * REPLACE (round(mean_price, 4) + 0.0 AS mean_price) FROM enriched",
    "enrichment_coverage": f"""WITH {ENRICHED}, n AS (
            SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE known) AS n_matched FROM (
                SELECT 'part' AS source, has_part AS known FROM enriched
                UNION ALL SELECT 'supplier', has_supplier FROM enriched
                UNION ALL SELECT 'orders', has_orders FROM enriched) GROUP BY source)
        SELECT source, n_rows, n_matched, {r('n_matched / n_rows', 'coverage')} FROM n""",
    "arrival_stream_sales": f"WITH {HOLDOUT} SELECT * FROM holdout",
    "arrival_stream_forecast": f"WITH {DELIVERED} {WALK_ROWS}",
    "grouped_map_weekday_mean": f"""WITH {TRAIN}, {OBS}, {weekday_mean('obs', 'store, item', ahead('last_ds', 30))}
        SELECT store, item, ds, {bounds()} FROM fc""",
    "grouped_map_item_forecast": f"""WITH {TRAIN}, {ITEM_OBS}, {weekday_mean('iobs', 'item', ahead('last_ds', 14))}
        SELECT item, ds, {bounds()} FROM fc""",
    "grouped_map_walk_forward": f"""WITH {walk('2001-09-30', '2001-10-06')},
        {weekday_mean('wobs', 'training_date, store, item', 'CAST(training_date + INTERVAL 1 DAY AS DATE)')}
        SELECT training_date, store, item, ds, {bounds()} FROM fc""",
}



def zero_filled(until: str) -> str:
    """The closed form over a full grid of days: every day of a series from its first sale to ``until`` is there, with 0."""
    return f"""grid AS (
        SELECT store, item, CAST(unnest(generate_series(min(date), {until}, INTERVAL 1 DAY)) AS DATE) AS ds FROM train GROUP BY store, item),
    obs AS (
        SELECT g.store, g.item, ds, CAST(coalesce(sales, 0) AS DOUBLE) AS y
        FROM grid g LEFT JOIN train t ON t.store = g.store AND t.item = g.item AND t.date = g.ds),
    {model('obs', 'store, item', 's_', ahead('last_ds', 30))} SELECT store, item, ds, {bounds()} FROM s_fc"""


ORACLE["moment_forecast"] = ORACLE["series_forecast"]
ORACLE["zero_filled_forecast"] = f"WITH {TRAIN}, {zero_filled('max(date)')}"
ORACLE["zero_filled_forecast_1000"] = f"WITH {sales('train', f'date < {CUT}', 50, 20)}, {zero_filled(f'{CUT} - INTERVAL 1 DAY')}"
#: Only days that have sales are delivered.
ORACLE["incremental_walk_forward"] = f"WITH {DELIVERED} {WALK_ROWS}".replace(
    f"WHERE date >= {CUT})", "WHERE date BETWEEN DATE '2001-09-30' AND DATE '2001-10-06')", 1
)
LATER_CORRECTED = sales().replace(
    "SELECT * FROM (", "SELECT date, store, item, CASE WHEN item = 1 AND date BETWEEN DATE '2001-10-02' AND DATE '2001-10-03' THEN sales + 1 ELSE sales END AS sales FROM (", 1
)
#: Every delivered day is a training date, and each forecast knows the sales as corrected.
ORACLE["corrected_forecast_store"] = f"WITH {DELIVERED} {WALK_ROWS}".replace(sales(), LATER_CORRECTED, 1).replace(
    f"WHERE date >= {CUT})", f"WHERE date >= {CUT} AND date < DATE '2001-10-07')", 1
)

NEXT = "CAST(training_date + INTERVAL 1 DAY AS DATE)"
SHARES_AT = """shares AS (
        SELECT training_date, item, store, sold AS store_item_sales, CAST(sum(sold) OVER (PARTITION BY training_date, item) AS BIGINT) AS item_sales
        FROM (SELECT training_date, item, store, CAST(sum(sales) AS BIGINT) AS sold FROM sales JOIN cut ON date <= training_date GROUP BY ALL))"""
BOTH_WALKED = f"""{WALK}, iwobs AS (
        SELECT training_date, item, date AS ds, CAST(sum(sales) AS DOUBLE) AS y FROM sales JOIN cut ON date <= training_date GROUP BY ALL),
    {model('iwobs', 'training_date, item', 'v_', NEXT)}, {SHARES_AT}, topdown AS (
        SELECT training_date, store, item, ds, yhat * store_item_sales / item_sales AS yhat
        FROM v_fc JOIN shares USING (training_date, item)),
    both_at AS (
        SELECT f.training_date, s.date, f.store, f.item, CAST(s.sales AS DOUBLE) AS y, f.yhat, t.yhat AS yhat_agg
        FROM w_fc f JOIN topdown t ON f.training_date = t.training_date AND f.store = t.store AND f.item = t.item AND f.ds = t.ds
        JOIN sales s ON s.date = f.ds AND s.store = f.store AND s.item = f.item)"""
ORACLE["walk_forward_overview"] = f"WITH {BOTH_WALKED} SELECT training_date, date, store, item, y, {r('yhat', 'yhat')}, {r('yhat_agg', 'yhat_agg')} FROM both_at"
STACKED_AT = """stacked AS (
        SELECT training_date, date, store, item, y, yhat, 'store_item' AS model FROM both_at UNION ALL
        SELECT training_date, date, store, item, y, yhat_agg, 'allocated' FROM both_at)"""
ORACLE["walk_forward_strategy_metrics"] = f"""WITH {BOTH_WALKED}, {STACKED_AT}
        SELECT training_date, model, count(*) AS n, CAST(0 AS BIGINT) AS n_null, {r('avg((y - yhat) ** 2)', 'mse')},
               {r('sqrt(avg((y - yhat) ** 2))', 'rmse')}, {r('avg(abs(y - yhat))', 'mae')} FROM stacked GROUP BY training_date, model"""
ORACLE["shares_at_cutoffs"] = f"""WITH {sales()}, {cutoffs('2001-09-30', '2001-10-06')}, {SHARES_AT}
        SELECT training_date, item, store, {r('store_item_sales / item_sales', 'ratio')}, store_item_sales, item_sales FROM shares"""
ORACLE["routed_forecast"] = f"""WITH {BOTH_WALKED}, {STACKED_AT}, late AS (SELECT training_date AS day FROM cut WHERE training_date >= DATE '2001-10-04'),
    scores AS (SELECT day, store, item, model, sqrt(avg((y - yhat) ** 2)) AS rmse FROM stacked JOIN late ON date <= day GROUP BY ALL),
    best AS (SELECT day, store, item, arg_min(model, (rmse, model)) AS model FROM scores GROUP BY ALL),
    candidates AS (SELECT training_date, store, item, ds, yhat, 'store_item' AS model FROM w_fc UNION ALL SELECT *, 'allocated' FROM topdown)
    SELECT c.training_date, c.store, c.item, c.ds, {r('yhat', 'yhat')}, c.model
    FROM candidates c JOIN late ON c.training_date = day LEFT JOIN best b ON b.day = c.training_date AND b.store = c.store AND b.item = c.item
    WHERE c.model = coalesce(b.model, 'store_item')"""

SUNDAYS = """cut AS (SELECT CAST(unnest(generate_series(DATE '2001-06-03', DATE '2001-08-26', INTERVAL 7 DAY)) AS DATE) AS training_date),
    cuts AS (SELECT * FROM cut WHERE training_date <> DATE '2001-07-29')"""
RATIO = 101 / 99
CALIBRATED = f"""{sales('all_sales')}, sales AS (SELECT * FROM all_sales WHERE date < DATE '2001-09-05'), {SUNDAYS}, wobs AS (
        SELECT training_date, store, item, date AS ds, CAST(sales AS DOUBLE) AS y FROM sales JOIN cuts ON date <= training_date),
    {model('wobs', 'training_date, store, item', 'w_', ahead('training_date', 7))}, pairs AS (
        SELECT f.training_date, date_diff('day', f.training_date, f.ds) AS step, yhat, yhat_lower, yhat_upper, (yhat_upper - yhat_lower) / 2 AS margin, s.sales AS y
        FROM w_fc f JOIN sales s ON f.ds = s.date AND f.store = s.store AND f.item = s.item),
    ratios AS (SELECT step, (y - yhat) / margin AS z FROM pairs WHERE training_date < DATE '2001-08-01' AND margin <> 0),
    buckets AS (SELECT step, CASE WHEN abs(z) < 1e-6 THEN 0 ELSE sign(z) * (ceil(ln(abs(z)) / ln({RATIO!r})) + 700) END AS b, count(*) AS n FROM ratios GROUP BY ALL),
    ranked AS (
        SELECT *, CASE WHEN b = 0 THEN 0.0 ELSE sign(b) * 2 * power({RATIO!r}, abs(b) - 700) / ({RATIO!r} + 1) END AS v,
               sum(n) OVER (PARTITION BY step ORDER BY b) AS below, sum(n) OVER (PARTITION BY step) AS total FROM buckets),
    quantiles AS (
        SELECT step, min(CASE WHEN below >= floor(0.025 * total) + 1 THEN v END) AS lo, max(CASE WHEN total - below + n >= floor(0.025 * total) + 1 THEN v END) AS hi
        FROM ranked GROUP BY step),
    held AS (
        SELECT p.*, coalesce(yhat + lo * margin, yhat_lower) AS c_lower, coalesce(yhat + hi * margin, yhat_upper) AS c_upper
        FROM pairs p LEFT JOIN quantiles q ON p.step = q.step WHERE training_date > DATE '2001-08-01')"""
ORACLE["calibrated_coverage"] = f"""WITH {CALIBRATED} SELECT CAST(step AS INTEGER) AS step, count(*) AS n,
        {r('avg(CASE WHEN yhat_lower < y AND y < yhat_upper THEN 1.0 ELSE 0.0 END)', 'accuracy')},
        {r('avg(CASE WHEN y < yhat_upper THEN 1.0 ELSE 0.0 END)', 'stocked')},
        {r('avg(CASE WHEN c_lower < y AND y < c_upper THEN 1.0 ELSE 0.0 END)', 'calibrated_accuracy')},
        {r('avg(CASE WHEN y < c_upper THEN 1.0 ELSE 0.0 END)', 'calibrated_stocked')} FROM held GROUP BY step"""
ORACLE["changes_between_versions"] = f"""WITH {GROWN}
        SELECT date, store, item, 'added' AS change, CAST(NULL AS BIGINT) AS before, sales AS after FROM grown WHERE arrival_version = 3
        UNION ALL SELECT date, store, item, 'changed', sales, sales + 1 FROM grown WHERE arrival_version = 2 AND item = 1
        UNION ALL SELECT date, store, item, 'removed', sales, NULL FROM grown WHERE arrival_version = 2 AND item = 2"""
ORACLE["quarantined_by_every_rule"] = f"""WITH {sales()}, broken AS (
        SELECT CASE WHEN store <> 5 THEN date END AS date, store, item, CASE item WHEN 2 THEN NULL WHEN 3 THEN '-' || sales WHEN 4 THEN sales || '.5'
               WHEN 5 THEN '100000' ELSE CAST(sales AS VARCHAR) END AS sales FROM sales),
    judged AS (
        SELECT *, CASE WHEN date IS NULL THEN 'not_null:date' WHEN item = 4 THEN 'type:sales' WHEN sales IS NULL THEN 'not_null:sales'
               WHEN CAST(sales AS DOUBLE) < 0 THEN 'low:sales' WHEN CAST(sales AS DOUBLE) > 100 THEN 'high:sales' END AS rule FROM broken)
    SELECT * FROM judged WHERE rule IS NOT NULL"""
ORACLE["forecast_without_missing_values"] = ORACLE["series_forecast"].replace(TRAIN, sales("train", f"date < {CUT} AND day(date) % 5 <> 0"), 1)
ORACLE["allocation_of_unmatched_items"] = f"""WITH {TRAIN}, {ITEMS.replace('FROM train GROUP', 'FROM train WHERE item <> 1 GROUP')},
    {SHARE.replace('FROM train GROUP', 'FROM train WHERE item <> 2 GROUP')}, alloc AS (
        SELECT store, item, ds, yhat * ratio AS yhat FROM i_fc FULL OUTER JOIN share USING (item))
    SELECT store, item, ds, {r('yhat', 'yhat')} FROM alloc"""

PROMOTIONS = """promotions AS (
        SELECT item, min(day) AS s, min(day) + 6 AS e, count(*) AS n_orders FROM (
            SELECT CAST(o_custkey % 10 + 1 AS INTEGER) AS item, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS p FROM orders)
        GROUP BY item, date_trunc('month', day){more})"""
ORACLE["sales_in_promotions"] = f"""WITH {sales()}, {PROMOTIONS.format(more='')}
    SELECT sales.*, n_orders, s IS NOT NULL AS has_promotion
    FROM sales LEFT JOIN promotions p ON p.item = sales.item AND date BETWEEN s AND least(e, last_day(s))"""
ORACLE["overlapping_promotions"] = f"""WITH {sales()}, {PROMOTIONS.format(more=', p')}
    SELECT date, store, sales.item, sales, count(s) AS n_promotion
    FROM sales LEFT JOIN promotions p ON p.item = sales.item AND date BETWEEN s AND e GROUP BY ALL"""
STRATA = f"""{sales(n_stores=10, n_items=50)}, volumes AS (
        SELECT store, item, CAST(sum(sales) AS DOUBLE) AS volume FROM sales GROUP BY store, item),
    bucketed AS (SELECT *, CAST(ceil(ln(volume) / ln({RATIO!r})) AS INTEGER) AS bucket FROM volumes),
    strata AS (
        SELECT b.*, CAST(floor(5.0 * (SELECT count(*) FROM bucketed o WHERE o.bucket < b.bucket) / (SELECT count(*) FROM bucketed)) AS INTEGER) AS stratum
        FROM bucketed b),
    chosen AS (SELECT * FROM strata QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY md5('|' || store || '|' || item), store, item) <= 20)"""
ORACLE["representative_sales"] = f"WITH {STRATA} SELECT sales.* FROM sales JOIN chosen USING (store, item)"
ORACLE["representative_strata"] = f"""WITH {STRATA}, whole AS (
        SELECT stratum, count(*) AS n_series, sum(volume) AS volume, count(*) * (max(volume) - min(volume)) AS bound FROM strata GROUP BY stratum),
    kept AS (SELECT stratum, count(*) AS n_kept, sum(volume) AS v FROM chosen GROUP BY stratum)
    SELECT stratum, n_series, n_kept, {r('n_series / n_kept', 'weight')}, {r('volume', 'volume')}, {r('v * n_series / n_kept', 'estimate')}, {r('bound', 'bound')}
    FROM whole JOIN kept USING (stratum)"""
DRIFT = f"""{GROWN}, sided AS (SELECT *, arrival_version = 3 AS late FROM grown WHERE arrival_version <= 3), long AS (
        SELECT late, unnest(['store', 'item', 'sales', 'date']) AS c,
               unnest([store, item, sales, date_diff('day', DATE '1970-01-01', date)]) AS v FROM sided),
    ordered AS (
        SELECT late, c, v, row_number() OVER (PARTITION BY late, c ORDER BY v) AS k, count(*) OVER (PARTITION BY late, c) AS n FROM long),
    near AS (SELECT late, c, k, n, 2 * power({RATIO!r}, ceil(ln(v) / ln({RATIO!r}))) / ({RATIO!r} + 1) AS v FROM ordered WHERE c <> 'date'),
    measured AS (
        SELECT late, c, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS v FROM long GROUP BY late, c
        UNION ALL SELECT late, c, 'null_share', 0.0 FROM long GROUP BY late, c
        UNION ALL SELECT late, c, 'distinct', count(DISTINCT v) FROM long WHERE c <> 'date' GROUP BY late, c
        UNION ALL SELECT late, c, 'min', min(v) FROM long GROUP BY late, c
        UNION ALL SELECT late, c, 'max', max(v) FROM long GROUP BY late, c
        UNION ALL SELECT late, c, 'p5', v FROM near WHERE k = floor(0.05 * (n - 1)) + 1
        UNION ALL SELECT late, c, 'p50', v FROM near WHERE k = floor(0.5 * (n - 1)) + 1
        UNION ALL SELECT late, c, 'p95', v FROM near WHERE k = floor(0.95 * (n - 1)) + 1),
    drift AS (
        SELECT c AS "column", metric, b.v AS before, a.v AS after, CASE WHEN a.v = b.v THEN 0.0 ELSE (a.v - b.v) / abs(nullif(b.v, 0)) END AS change
        FROM (SELECT * FROM measured WHERE NOT late) b FULL JOIN (SELECT * FROM measured WHERE late) a USING (c, metric))"""
ORACLE["version_drift"] = f"WITH {DRIFT} SELECT \"column\", metric, {r('before', 'before')}, {r('after', 'after')}, {r('change', 'change')} FROM drift"
ORACLE["version_drift_alerts"] = f"""WITH {DRIFT}, rules AS (
        SELECT * FROM (VALUES ('sales', 'p50', -0.1, 0.1), ('sales', 'null_share', NULL, 0.0), ('item', 'distinct', 0.0, NULL), ('sales', 'mean', NULL, NULL)) t(c, m, l, h))
    SELECT c AS "column", m AS metric, {r('change', 'value')}, CAST(l AS DOUBLE) AS low, CAST(h AS DOUBLE) AS high,
           coalesce(change < l, false) OR coalesce(change > h, false) OR change IS NULL AS breached
    FROM rules LEFT JOIN drift ON "column" = c AND metric = m"""

# Forecasts that come back from the store.
ORACLE |= {f"stored_forecast_{name}": ORACLE[f"walk_forward_{name}"] for name in ("actuals", "metrics")}
# The grouped-map path restates the closed form.
ORACLE |= {f"grouped_map_{name}": ORACLE[f"series_{name}"] for name in ("forecast", "forecast_500")}
ORACLE["grouped_map_walk_forward_by_cost"] = ORACLE["grouped_map_walk_forward"]
# The aggregates of the clean layer are the plain ones over the corrected sales.
ORACLE |= {
    f"layered_{name}": ORACLE[name].replace(f"WITH {sales()}", f"WITH {CORRECTED}, sales AS (SELECT * FROM newest)", 1)
    for name in ("sales_by_year", "sales_by_month", "weekday_profile", "store_month_profile")
}
ORACLE["layered_item_month_profile"] = ORACLE["item_all_month_profile"].replace(
    f"WITH {sales()}", f"WITH {CORRECTED}, sales AS (SELECT * FROM newest)", 1
)
ORACLE["layered_item_daily_sales"] = f"WITH {CORRECTED} SELECT item, date, CAST(sum(sales) AS BIGINT) AS sales FROM newest GROUP BY item, date"
