"""A development copy that looks like the whole: whole series, the same number from every stratum of volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.calibrate import bucket_sql
from seriesmill.operators.forecast import KEYS


def series_strata(df: DataFrame, keys: Sequence[str] = KEYS, strata: int = 10, value: str = "sales") -> DataFrame:
    """keys, volume, stratum: the total of each series, and the volume quantile it lies in, from 0.

    Quantiles are cut between buckets of volumes within 2% of each other, from their counts; series of
    one bucket share a stratum. Nothing is sorted but some thousand buckets. A missing value counts as 0.
    """
    totals = df.groupBy(*keys).agg(F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("volume"))
    volumes = totals.withColumn("bucket", F.expr(bucket_sql("volume")))
    counts = volumes.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket")) - F.col("n")
    total = F.sum("n").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cut = counts.select("bucket", F.floor(before * F.lit(strata) / total).cast("int").alias("stratum"))
    return volumes.join(cut, "bucket").select(*keys, "volume", "stratum")


def representative_series(series: DataFrame, keys: Sequence[str] = KEYS, per_stratum: int = 100, seed: str = "") -> DataFrame:
    """Of ``series_strata``, the ``per_stratum`` series of smallest hash in each stratum.

    The choice depends on the keys and the seed alone: it is the same on every run, and a series stays
    chosen while its stratum and its rivals do. Each task sends no more than ``per_stratum`` rows of
    a stratum.
    """
    code = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))
    by_hash = Window.partitionBy("stratum").orderBy(code, *keys)
    return series.withColumn("_rank", F.row_number().over(by_hash)).where(F.col("_rank") <= per_stratum).drop("_rank")


def representative_copy(df: DataFrame, chosen: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All rows of the chosen series."""
    names = chosen.select(*[F.col(k).alias(f"_chosen_{n}") for n, k in enumerate(keys)])
    return df.join(names, [df[k].eqNullSafe(F.col(f"_chosen_{n}")) for n, k in enumerate(keys)], "left_semi")


def stratum_report(series: DataFrame, chosen: DataFrame) -> DataFrame:
    """Per stratum how well the chosen series stand for all: stratum, n_series, n_kept, weight, volume, estimate, bound.

    ``weight`` is the number of series that a chosen one stands for and ``estimate`` the volume that follows.
    It is off by no more than ``bound``, the number of series times the range of their volumes.
    """
    whole = series.groupBy("stratum").agg(
        F.count("*").alias("n_series"), F.sum("volume").alias("volume"),
        (F.count("*") * (F.max("volume") - F.min("volume"))).alias("bound"),
    )
    kept = chosen.groupBy("stratum").agg(F.count("*").alias("n_kept"), F.sum("volume").alias("kept_volume"))
    weight = F.col("n_series") / F.col("n_kept")
    return whole.join(kept, "stratum").select(
        "stratum", "n_series", "n_kept", weight.alias("weight"), "volume", (F.col("kept_volume") * weight).alias("estimate"), "bound"
    )
