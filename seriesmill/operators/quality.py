"""Checks and preparation of the clean layer: enforcement, duplicates, metrics, alerts, samples, enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from seriesmill.sources.contract import Contract


def enforce(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every row rule, in the declared types, and the others with the first broken ``_rule``.

    Columns outside the contract pass through.
    """
    checked = df.withColumn("_rule", contract.first_broken_rule(df.schema))
    good = checked.where(F.col("_rule").isNull()).withColumns(contract.typed()).drop("_rule")
    bad = checked.where(F.col("_rule").isNotNull())
    return good, bad


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key; remaining columns settle ties.

    An aggregate, not a ranking window: copies are dropped before the shuffle, so a key with very
    many copies costs its task no more than one row per upstream task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order and c not in keys]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def _metric(column: str, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"), F.lit(metric).alias("metric"), value.cast("double").alias("value")
    )


def profile(df: DataFrame, custom: Mapping[str, str] | None = None, approximate: bool = False) -> DataFrame:
    """Quality metrics in one pass: column, metric, value.

    Per column: rows, nulls, distinct, and for numbers and dates min and max (dates as days since
    1970-01-01); for dates also ``missing_days`` between the first and the last. ``custom`` adds
    metrics of the whole table (column ``*``) as SQL aggregates. ``approximate`` estimates the
    distinct counts, which spares wide tables the expansion that exact ones need.
    """
    count_distinct = F.approx_count_distinct if approximate else F.count_distinct
    sums, metrics = [F.count("*").alias("rows")], [_metric("*", "rows", F.col("rows"))]
    for i, field in enumerate(df.schema.fields):
        name, c = field.name, F.col(field.name)
        sums += [F.count_if(c.isNull()).alias(f"nulls{i}"), count_distinct(c).alias(f"distinct{i}")]
        metrics += [
            _metric(name, "nulls", F.col(f"nulls{i}")),
            _metric(name, "distinct", F.col(f"distinct{i}")),
        ]
        if isinstance(field.dataType, (NumericType, DateType)):
            number = F.unix_date(c) if isinstance(field.dataType, DateType) else c
            sums += [F.min(number).alias(f"min{i}"), F.max(number).alias(f"max{i}")]
            metrics += [_metric(name, "min", F.col(f"min{i}")), _metric(name, "max", F.col(f"max{i}"))]
        if isinstance(field.dataType, DateType):
            span = F.col(f"max{i}") - F.col(f"min{i}") + 1
            metrics.append(_metric(name, "missing_days", span - F.col(f"distinct{i}")))
    for i, (name, expression) in enumerate((custom or {}).items()):
        sums.append(F.expr(expression).alias(f"custom{i}"))
        metrics.append(_metric("*", name, F.col(f"custom{i}")))
    return df.agg(*sums).select(F.inline(F.array(*metrics)))


@dataclass(frozen=True)
class AlertRule:
    """A metric is in breach below ``low`` or above ``high``."""

    column: str
    metric: str
    low: float | None = None
    high: float | None = None


def alerts(metrics: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Every rule next to its metric: column, metric, value, low, high, breached.

    A rule whose metric is missing or NULL is in breach: nothing shows that it holds.
    """
    declared = metrics.sparkSession.createDataFrame(
        [(r.column, r.metric, *(None if b is None else float(b) for b in (r.low, r.high))) for r in rules],
        "`column` STRING, metric STRING, low DOUBLE, high DOUBLE",
    )
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    kept = value.isNotNull() & F.coalesce(value >= low, F.lit(True)) & F.coalesce(value <= high, F.lit(True))
    return declared.join(metrics, ["column", "metric"], "left").select(
        "column", "metric", "value", "low", "high", (~kept).alias("breached")
    )


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Number of rows against each rule of the contract: rule, column, n_bad, including zeros.

    One scan serves all rules. With a unique key the counts are first taken per key, which the
    search for duplicates needs anyway; one key is a single row after the partial sums.
    """

    def finding(rule: str, column: str, n: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), n.cast("bigint").alias("n_bad"))

    missing = [c.name for c in contract.columns if c.name not in df.columns]
    rules = [r for r in contract.row_rules(df.schema) if r[1] not in missing]
    key = [] if set(contract.unique_key) & set(missing) else list(contract.unique_key)
    counts = [F.count("*").alias("rows"), *[F.count_if(broken).alias(f"bad{i}") for i, (_, _, broken) in enumerate(rules)]]
    findings = [finding("missing", name, F.col("rows")) for name in missing]
    findings += [finding(rule, name, F.col(f"bad{i}")) for i, (rule, name, _) in enumerate(rules)]
    if key:
        sums = [F.sum("rows").alias("rows"), F.sum(F.col("rows") - 1).alias("extra")]
        sums += [F.sum(f"bad{i}").alias(f"bad{i}") for i in range(len(rules))]
        total = df.groupBy(*key).agg(*counts).agg(*sums).na.fill(0)
        findings.append(finding("unique", ",".join(key), F.col("extra")))
    else:
        total = df.agg(*counts)
    return total.select(F.inline(F.array(*findings)))


def sample_series(df: DataFrame, keys: Sequence[str], n: int, part: int = 0) -> DataFrame:
    """About one in ``n`` series with all of its rows, chosen by the hash of the key, without a shuffle."""
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(n)) == part)


@dataclass(frozen=True)
class Source:
    """Attributes to add to sales, one row per ``on``."""

    name: str
    df: DataFrame
    on: tuple[str, ...]


def enrich(sales: DataFrame, *sources: Source) -> DataFrame:
    """Left-join each source; ``has_<name>`` tells whether it knew the row.

    A source with two rows for one key would multiply sales, so it fails the job instead.
    """
    for source in sources:
        attributes = [c for c in source.df.columns if c not in source.on]
        flag = f"has_{source.name}"
        # Attributes come out of the checked struct, so that no choice of columns can drop the check.
        row = F.struct(F.lit(True).alias(flag), *[F.first(c).alias(c) for c in attributes])
        checked = F.when(F.count("*") == 1, row).otherwise(F.raise_error(F.lit(f"source {source.name} has several rows for one key")))
        one_each = source.df.groupBy(*source.on).agg(checked.alias("_row")).select(*source.on, "_row.*")
        sales = sales.join(one_each, list(source.on), "left").select(
            *sales.columns, *attributes, F.coalesce(flag, F.lit(False)).alias(flag)
        )
    return sales


def enrichment_coverage(enriched: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of rows that each source knew: source, n_rows, n_matched, coverage."""
    counts = enriched.agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(f"has_{n}")).alias(f"n_{n}") for n in names]
    )
    stacked = ", ".join(f"'{n}', `n_{n}`" for n in names)
    return counts.select("n_rows", F.expr(f"stack({len(names)}, {stacked}) AS (source, n_matched)")).select(
        "source",
        "n_rows",
        "n_matched",
        F.try_divide(F.col("n_matched").cast("double"), F.col("n_rows").cast("double")).alias("coverage"),
    )
