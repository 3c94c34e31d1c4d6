"""Sources that hold for a period, such as promotions: matched by key and day in one sorted pass.

Sales and the starts and ends of periods are laid out in one sequence per key, and what holds on a day is
read from running values; no sale is compared with more than its own neighbours. Keys are cut into
blocks of days, so that one with a third of all sales is spread, and a period stands once in every
block that it touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 16


@dataclass(frozen=True)
class Periods:
    """Attributes that hold for ``on`` from ``start`` to ``end``, both days included.

    A period without a key, start or end, or one that ends before it starts, holds on no day.
    """

    name: str
    df: DataFrame
    on: tuple[str, ...]
    start: str = "start"
    end: str = "end"

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.df.columns if c not in (*self.on, self.start, self.end)]


def _block(day: Column, block_days: int) -> Column:
    return F.floor(day / F.lit(block_days)).cast("int")


def _running(sales: DataFrame, periods: Periods, block_days: int) -> DataFrame:
    """row (a sale), active (number of periods that hold on its day), period (the last of them to end, with ``until``)."""
    if not periods.on:
        raise ValueError("periods need at least one key")
    keys = [f"key{n}" for n in range(len(periods.on))]
    day = F.unix_date("date")
    rows = sales.select(
        *[F.col(f"`{k}`").alias(i) for k, i in zip(periods.on, keys)],
        _block(day, block_days).alias("block"), day.alias("day"), F.lit(1).alias("turn"), F.lit(0).alias("change"),
        F.struct(*[F.col(f"`{c}`") for c in sales.columns]).alias("row"),
    )
    first, last = F.unix_date(F.col(f"`{periods.start}`").cast("date")), F.unix_date(F.col(f"`{periods.end}`").cast("date"))
    period = F.struct(last.alias("until"), *[F.col(f"`{c}`").alias(f"a{n}") for n, c in enumerate(periods.attributes)])
    known = periods.df.select(
        *[F.col(f"`{k}`").cast(rows.schema[i].dataType).alias(i) for k, i in zip(periods.on, keys)],
        first.alias("first"), last.alias("last"), period.alias("period"),
    ).where("first <= last").na.drop(subset=keys)
    pieces = known.withColumn("block", F.explode(F.sequence(_block(F.col("first"), block_days), _block(F.col("last"), block_days))))
    begin = F.greatest("first", F.col("block") * block_days)
    bounds = F.array(
        F.struct(begin.alias("day"), F.lit(1).alias("change"), F.col("period")),
        F.struct((F.col("last") + 1).alias("day"), F.lit(-1).alias("change"), F.lit(None).cast(known.schema["period"].dataType).alias("period")),
    )
    events = pieces.select(*keys, "block", F.inline(bounds)).where(_block(F.col("day"), block_days) == F.col("block")).withColumn("turn", F.lit(0))
    # Bounds of a day come before its sales; among themselves their order does not matter.
    so_far = Window.partitionBy(*keys, "block").orderBy("day", "turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.unionByName(events, allowMissingColumns=True).select(
        "row",
        F.sum("change").over(so_far).alias("active"),
        F.max_by("period", F.col("period.until")).over(so_far).alias("period"),
    ).where("row IS NOT NULL")


def enrich_with_periods(sales: DataFrame, *sources: Periods, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Sales with the attributes of the period that holds on their day, and ``has_<name>`` for whether one does.

    Two periods that hold for one sale would multiply it, so they fail the job instead; periods may overlap
    where nothing was sold. A sale without date or key has no period.
    """
    for source in sources:
        flag, attributes = f"has_{source.name}", source.attributes
        taken = set(sales.columns) & {*attributes, flag}
        if taken:
            raise ValueError(f"sales have columns called {sorted(taken)} already")
        holds = F.when(F.col("active") <= 1, F.col("active") == 1).otherwise(
            F.raise_error(F.lit(f"several periods of {source.name} hold for one sale")).cast("boolean")
        )
        # The one period that holds is the last to end of those begun, as all others are over. Every
        # attribute depends on the check, so that no choice of columns can drop it.
        found = _running(sales, source, block_days).withColumn("holds", holds)
        sales = found.select(
            *[F.col(f"row.`{c}`").alias(c) for c in sales.columns],
            *[F.when(F.col("holds"), F.col(f"period.a{n}")).alias(c) for n, c in enumerate(attributes)],
            F.col("holds").alias(flag),
        )
    return sales


def count_periods(sales: DataFrame, periods: Periods, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Sales with ``n_<name>``, the number of periods that hold on their day; these may overlap."""
    found = _running(sales, periods, block_days)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in sales.columns], F.col("active").alias(f"n_{periods.name}"))
