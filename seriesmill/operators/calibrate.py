"""Prediction intervals calibrated on what walk-forward residuals have been, per step ahead.

Residuals are measured in margins of the normal interval and counted in buckets of equal ratio, so
that any quantile is known within a stated relative error (Masson, Rim and Lee, DDSketch, 2019). Counts
add up: sketches of other cutoffs, versions or clusters are merged by a sum, without a look at rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.evaluate import coverage_metrics

#: Relative error of a quantile, and the smallest ratio to a margin that is told from 0.
ERROR, SMALLEST = 0.01, 1e-6
GAMMA = (1 + ERROR) / (1 - ERROR)
#: Makes all buckets of positive ratios positive.
OFFSET = math.ceil(-math.log(SMALLEST) / math.log(GAMMA)) + 1

_RATIO = "(CAST(y AS DOUBLE) - yhat) / nullif((yhat_upper - yhat_lower) / 2, 0)"
#: Middle of a bucket.
BUCKET_VALUE = f"CASE WHEN bucket = 0 THEN 0.0D ELSE sign(bucket) * 2 * power({GAMMA!r}D, abs(bucket) - {OFFSET}) / ({GAMMA!r}D + 1) END"


def bucket_sql(number: str) -> str:
    """The bucket of a finite number, as SQL."""
    return f"""CAST(CASE WHEN abs({number}) < {SMALLEST}D THEN 0
        ELSE sign({number}) * (ceil(ln(abs({number})) / {math.log(GAMMA)!r}D) + {OFFSET}) END AS INT)"""


def residual_sketch(pairs: DataFrame) -> DataFrame:
    """step, bucket, n: counts of the residuals of (training_date, ds, y, yhat and bounds) by days ahead.

    Pairs without a value, a forecast or a margin are left out.
    """
    steps = pairs.selectExpr("datediff(ds, training_date) AS step", f"{_RATIO} AS ratio").where("ratio IS NOT NULL AND NOT isnan(ratio)")
    return steps.selectExpr("step", f"{bucket_sql('ratio')} AS bucket").groupBy("step", "bucket").agg(F.count("*").alias("n"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("step", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, level: float = 0.95) -> DataFrame:
    """step, lower, upper: the quantiles that leave (1 - level) / 2 of the residuals on either side, in margins.

    A quantile is the bucket in which the cumulative count reaches its rank, the first for the lower
    side and counted from above for the upper.
    """
    by_bucket = Window.partitionBy("step").orderBy("bucket")  # some thousand buckets at most
    share = (1 - level) / 2
    counted = sketch.select(
        "step", "bucket", "n",
        F.sum("n").over(by_bucket).alias("below"),
        F.sum("n").over(Window.partitionBy("step")).alias("total"),
    ).withColumn("value", F.expr(BUCKET_VALUE))
    rank = F.greatest(F.floor(F.lit(share) * F.col("total")), F.lit(0)) + 1  # from either end
    return counted.groupBy("step").agg(
        F.min(F.when(F.col("below") >= rank, F.struct("bucket", "value")))["value"].alias("lower"),
        F.max(F.when(F.col("total") - F.col("below") + F.col("n") >= rank, F.struct("bucket", "value")))["value"].alias("upper"),
    )


def calibrated(forecasts: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Forecasts with bounds from the quantiles of their step ahead; a step that has none keeps its bounds."""
    margin = (F.col("yhat_upper") - F.col("yhat_lower")) / 2
    steps = forecasts.withColumn("step", F.datediff("ds", "training_date")).join(quantiles, "step", "left")
    bounds = {
        "yhat_lower": F.coalesce(F.col("yhat") + F.col("lower") * margin, F.col("yhat_lower")),
        "yhat_upper": F.coalesce(F.col("yhat") + F.col("upper") * margin, F.col("yhat_upper")),
    }
    return steps.select(*[bounds.get(c, F.col(c)).alias(c) for c in forecasts.columns])


def coverage_by_step(pairs: DataFrame) -> DataFrame:
    """step, n, accuracy, stocked of pairs by days ahead."""
    stepped = pairs.withColumn("step", F.datediff("ds", "training_date"))
    return coverage_metrics(stepped, ["step"]).select("step", "n", "accuracy", "stocked")
