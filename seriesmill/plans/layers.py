"""Raw, clean and aggregate layers of the sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seriesmill.operators import explore
from seriesmill.operators.quality import dedup, enforce
from seriesmill.sources.contract import SALES_CONTRACT, Contract
from seriesmill.sources.tables import read_table, save


def clean_sales(
    raw: DataFrame, contract: Contract = SALES_CONTRACT, latest_by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): rows that keep the contract, one per unique key.

    ``latest_by`` names the columns whose greatest values win among rows of one key; they may lie
    outside the contract.
    """
    good, bad = enforce(raw, contract)
    if contract.unique_key:
        good = dedup(good, contract.unique_key, latest_by)
    return good.select(*[c.name for c in contract.columns]), bad


AGGREGATES = {
    "sales_by_year": explore.sales_by_year,
    "sales_by_month": explore.sales_by_month,
    "weekday_profile": explore.weekday_profile,
    "store_month_profile": explore.store_month_profile,
    "item_month_profile": lambda sales: explore.month_profile(sales, ["item", "store"]),
    "item_daily_sales": explore.item_daily_sales,
}


def build_layers(
    raw: DataFrame, target: str, contract: Contract = SALES_CONTRACT, latest_by: Sequence[str] = ()
) -> dict[str, str]:
    """Write the clean layer once, then each aggregate from it; returns the path of every table.

    ``target`` is a folder that all executors can reach. The clean table is read back rather than
    cached, so a lost executor costs no recomputation of the raw layer.
    """
    spark = raw.sparkSession
    clean, bad = clean_sales(raw, contract, latest_by)
    paths = {name: f"{target}/{name}" for name in ("clean", "quarantine", *AGGREGATES)}
    save(clean, paths["clean"], mode="overwrite")
    save(bad, paths["quarantine"], mode="overwrite")
    for name, build in AGGREGATES.items():
        save(build(read_table(spark, paths["clean"])), paths[name], mode="overwrite")
    return paths
