"""Top-down forecast: one forecast per item, split over stores by their historic share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.dates import as_date


def store_share(sales: DataFrame) -> DataFrame:
    """Share of each store in the sales of each item; NULL where the item never sold.

    The item total is a second, pre-aggregated sum that is joined back. A window over the item
    would pull all stores of one item into one task.
    """
    per_store = sales.groupBy("item", "store").agg(F.sum("sales").alias("store_item_sales"))
    per_item = per_store.groupBy("item").agg(F.sum("store_item_sales").alias("item_sales"))
    ratio = F.try_divide(F.col("store_item_sales").cast("double"), F.col("item_sales").cast("double"))
    return per_store.join(per_item, "item").select(
        "item", "store", ratio.alias("ratio"), "store_item_sales", "item_sales"
    )


def shares_at(sales: DataFrame, cutoffs: Sequence[dt.date | str]) -> DataFrame:
    """``store_share`` of all sales up to each cutoff, with training_date; stores count from their first day on.

    Sales are added up by the first cutoff that sees them. Of a store and item one row is left, with
    its sums at all cutoffs as an array, and items are added up from these rows: what is shuffled has
    as many rows as stores and items, however many cutoffs there are.
    """
    dates = sorted({as_date(c) for c in cutoffs})
    days = F.array(*map(F.lit, dates))
    bucket = F.size(F.filter(days, lambda c: c < F.col("date")))
    seen = sales.where(F.col("date") <= F.lit(dates[-1])).groupBy("item", "store", bucket.alias("bucket")).agg(F.sum("sales").alias("sold"))

    kind = seen.schema["sold"].dataType
    buckets = F.collect_list(F.struct("bucket", F.coalesce("sold", F.lit(0).cast(kind)).alias("sold")))  # at most one entry a cutoff

    def up_to(k: Column) -> Column:
        known = F.filter("buckets", lambda b: b["bucket"] <= k)
        return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast(kind), lambda total, b: (total + b["sold"]).cast(kind)))

    sums = F.transform(F.sequence(F.lit(0), F.lit(len(dates) - 1)), up_to)
    per_store = seen.groupBy("item", "store").agg(buckets.alias("buckets")).select("item", "store", sums.alias("sums"))
    totals = [F.sum(F.element_at("sums", k + 1)).alias(f"total{k}") for k in range(len(dates))]
    per_item = per_store.groupBy("item").agg(*totals).select("item", F.array(*[f"total{k}" for k in range(len(dates))]).alias("totals"))
    rows = per_store.join(per_item, "item").select("item", "store", F.explode(F.arrays_zip(days.alias("training_date"), "sums", "totals")).alias("row"))
    ratio = F.try_divide(F.col("row.sums").cast("double"), F.col("row.totals").cast("double"))
    return rows.where("row.sums IS NOT NULL").select(
        F.col("row.training_date").alias("training_date"), "item", "store", ratio.alias("ratio"), F.col("row.sums").alias("store_item_sales"), F.col("row.totals").alias("item_sales")
    )


def allocate(item_forecast: DataFrame, share: DataFrame) -> DataFrame:
    """Item forecast times store share: store, item, ds, yhat.

    A full outer match on the item: a share without forecast keeps its store, a forecast without
    share keeps its days, and yhat is NULL in both. It is stated as a left join plus the unmatched
    forecasts, because adaptive execution can split an item with very many stores in a left join
    but not in a full outer one.
    """
    daily = item_forecast.select("item", "ds", "yhat")
    matched = share.join(daily, "item", "left").select(
        "store", "item", "ds", (F.col("yhat") * F.col("ratio")).alias("yhat")
    )
    store_type = share.schema["store"].dataType
    unmatched = daily.join(share.select("item").distinct(), "item", "left_anti").select(
        F.lit(None).cast(store_type).alias("store"), "item", "ds", F.lit(None).cast("double").alias("yhat")
    )
    return matched.unionByName(unmatched)
