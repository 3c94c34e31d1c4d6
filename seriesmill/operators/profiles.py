"""Quality profiles that add up: a state per arrival version, merged without a look at its rows.

A state holds counts, least and greatest values, a HyperLogLog sketch of the distinct values, and counts
of numbers in buckets of equal ratio. Any set of versions is merged from their states, so the profile of a grown
table costs a day's rows, and a version can be compared with all that came before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from seriesmill.operators.calibrate import BUCKET_VALUE, bucket_sql
from seriesmill.operators.quality import AlertRule, alerts
from seriesmill.sources.tables import VERSION

PROBABILITIES = (0.05, 0.5, 0.95)


def profile_state(df: DataFrame, columns: Sequence[str] | None = None, by: str = VERSION) -> DataFrame:
    """State of each version: by, column, bucket, n, nulls, low, high, distinct.

    The row without bucket holds the rows and nulls of a column, its range (dates as days since 1970-01-01)
    and the sketch; rows with a bucket hold counts of numbers. NaN and infinite numbers count as nulls.
    """
    columns = [c for c in columns or df.columns if c != by]
    sums, summaries, buckets = [], [], []
    for i, name in enumerate(columns):
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        number = F.lit(None).cast("double")
        if isinstance(kind, DateType):
            number = F.unix_date(c).cast("double")
        elif isinstance(kind, NumericType):
            number = c.cast("double")
            c = F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), c)
            number = c.cast("double")
            buckets.append(F.struct(F.lit(name).alias("column"), number.alias("number")))
        sums += [
            F.count_if(c.isNull()).alias(f"nulls{i}"), F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}"),
            F.hll_sketch_agg(c.cast("string")).alias(f"distinct{i}"),
        ]
        summaries.append(F.struct(
            F.lit(name).alias("column"), F.col("n"),
            *[F.col(f"{part}{i}").alias(part) for part in ("nulls", "low", "high", "distinct")],
        ))
    summary = df.groupBy(by).agg(F.count("*").alias("n"), *sums).select(by, F.inline(F.array(*summaries)))
    if not buckets:
        return summary.withColumn("bucket", F.lit(None).cast("int"))
    numbers = df.select(by, F.inline(F.array(*buckets))).where("number IS NOT NULL")
    counted = numbers.selectExpr(f"`{by}`", "`column`", f"{bucket_sql('number')} AS bucket").groupBy(by, "column", "bucket").agg(F.count("*").alias("n"))
    return summary.unionByName(counted, allowMissingColumns=True)


def merge_states(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of each ``by``, or all of them, as one."""
    return state.groupBy(*by, "column", "bucket").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def state_metrics(merged: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """column, metric, value of one merged state: rows, null_share, distinct, min, max, and quantiles as p<percent>.

    Quantiles are within 1% of the exact value, distinct counts usually within 2%. What a column does not have, such as
    quantiles of a text, is left out.
    """
    summary = merged.where("bucket IS NULL").select("column", F.inline(F.array(*[
        F.struct(F.lit(metric).alias("metric"), F.expr(value).cast("double").alias("value"))
        for metric, value in (
            ("rows", "n"), ("null_share", "nulls / n"), ("distinct", "hll_sketch_estimate(distinct)"), ("min", "low"), ("max", "high"),
        )
    ]))).where("value IS NOT NULL")
    by_bucket = Window.partitionBy("column").orderBy("bucket")  # some thousand buckets at most
    counted = merged.where("bucket IS NOT NULL").select(
        "column", "bucket", F.expr(BUCKET_VALUE).alias("value"),
        F.sum("n").over(by_bucket).alias("below"), F.sum("n").over(Window.partitionBy("column")).alias("total"),
    )
    names = [f"p{100 * p:g}" for p in probabilities]
    reached = [
        F.min(F.when(F.col("below") > F.floor(F.lit(p) * (F.col("total") - 1)), F.struct("bucket", "value")))["value"].alias(name)
        for p, name in zip(probabilities, names)
    ]
    if not names:
        return summary
    quantiles = counted.groupBy("column").agg(*reached).select("column", F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").alias("value")) for name in names
    ])))
    return summary.unionByName(quantiles)


def drift(state: DataFrame, version: int, by: str = VERSION, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """column, metric, before, after, change: a version's profile against that of all versions before it, merged.

    ``change`` is relative to ``before``, and NULL where that is 0 or missing and ``after`` is not the same.
    Only states are read.
    """
    before = state_metrics(merge_states(state.where(F.col(by) < version)), probabilities).withColumnRenamed("value", "before")
    after = state_metrics(merge_states(state.where(F.col(by) == version)), probabilities).withColumnRenamed("value", "after")
    change = F.when(F.col("before") == F.col("after"), 0.0).otherwise(F.try_divide(F.col("after") - F.col("before"), F.abs("before")))
    return before.join(after, ["column", "metric"], "full").select("column", "metric", "before", "after", change.alias("change"))


def drift_alerts(drifted: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """``alerts`` on changes: a rule's bounds are relative changes, and one that cannot be measured is in breach."""
    return alerts(drifted.select("column", "metric", F.col("change").alias("value")), rules)
