"""Daily unit sales per store and item, and the reads that produce them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.dates import as_date

SALES_DDL = "date DATE, store INT, item INT, sales BIGINT"


def read_lines(
    spark: SparkSession,
    folder: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Order lines shipped from ``start`` up to, but without, ``end``.

    The range is stated on the stored timestamp rather than on its date, so that the Parquet
    scan can skip row groups.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    if start is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(str(as_date(start))).cast("timestamp_ntz"))
    if end is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(str(as_date(end))).cast("timestamp_ntz"))
    return lines


def line_sales(
    lines: DataFrame, n_stores: int = 5, n_items: int = 10, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per order line with the columns of the sales table, and those to ``keep``; not yet daily totals."""
    return lines.select(
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_suppkey") % n_stores + 1).cast("int").alias("store"),
        (F.col("l_partkey") % n_items + 1).cast("int").alias("item"),
        F.col("l_quantity").alias("sales"),
        *keep,
    )


def daily_sales(
    spark: SparkSession,
    folder: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    n_stores: int = 5,
    n_items: int = 10,
) -> DataFrame:
    """Sales table (date, store, item, sales): one row per store, item and day."""
    rows = line_sales(read_lines(spark, folder, start, end), n_stores, n_items)
    return rows.groupBy("date", "store", "item").agg(F.sum("sales").cast("bigint").alias("sales"))


def time_split(sales: DataFrame, cut: dt.date | str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cut`` and rows from ``cut`` on. A NULL date is in neither part."""
    edge = F.lit(as_date(cut))
    return sales.where(F.col("date") < edge), sales.where(F.col("date") >= edge)
