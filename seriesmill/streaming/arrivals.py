"""Daily deliveries as a stream: every file is taken in once, then all series are forecast from the new days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.forecast import KEYS, ForecastSpec
from seriesmill.operators.quality import enforce
from seriesmill.plans.retrain import train_on_version
from seriesmill.plans.walk_forward import NEXT_DAY
from seriesmill.sources.contract import SALES_CONTRACT, Contract
from seriesmill.sources.sales import SALES_DDL
from seriesmill.sources.tables import VERSION, exists, latest_version, newest_version, read_table, save, save_partition


def seed(sales: DataFrame, target: str) -> None:
    """Start the growing table: version 0 is everything known before the first delivery.

    Written without the rebalancing of later versions, which would shuffle the whole history once.
    """
    save(sales.withColumn(VERSION, F.lit(0).cast("bigint")), target, partition_by=[VERSION])


def current_sales(spark: SparkSession, target: str) -> DataFrame:
    """The growing table as of now; a day that was delivered again counts in its newest version."""
    return newest_version(read_table(spark, target)).drop(VERSION)


def _first_version(spark: SparkSession, table: str, checkpoint: str) -> int:
    """The version before this stream's first batch, noted beside its checkpoint when it starts.

    A stream with a new checkpoint counts its batches from 0 again; without the note it would write
    over the versions that an earlier stream has landed.
    """
    note = f"{checkpoint.rstrip('/')}-first-version"
    if exists(spark, note):
        return spark.read.parquet(note).first()[0]
    newest = (latest_version(read_table(spark, table)).first()[0] or 0) if exists(spark, table) else 0
    save(spark.range(1).select(F.lit(int(newest)).cast("bigint").alias(VERSION)), note)
    return int(newest)


def run_arrivals(
    spark: SparkSession,
    in_dir: str,
    table: str,
    checkpoint: str,
    forecasts: str | None = None,
    keys: Sequence[str] = KEYS,
    spec: ForecastSpec = NEXT_DAY,
    contract: Contract = SALES_CONTRACT,
) -> None:
    """Take in all files that are new in ``in_dir`` and return.

    Each micro-batch becomes one version of ``table``. A batch that is run again after a failure has
    the same number and replaces its own partition, so every row counts once. Rows that break the
    contract go to ``<table>_quarantine`` under the same version. If ``forecasts`` names a table, all
    series are then forecast from every day that the batch brought, each from the sales up to it, and
    stored by that training date. New days cost no look at the history (``train_on_version``), and a
    day that was delivered again also redoes the later training dates that had seen it.
    """
    base = _first_version(spark, table, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        version = F.lit(base + batch_id + 1).cast("bigint")
        good, bad = enforce(batch, contract)
        save_partition(good.withColumn(VERSION, version), table, VERSION)
        save_partition(bad.withColumn(VERSION, version), f"{table.rstrip('/')}_quarantine", VERSION)
        if forecasts is not None and exists(spark, table):
            train_on_version(spark, table, base + batch_id + 1, forecasts, keys, spec)

    (
        spark.readStream.schema(SALES_DDL)
        .parquet(in_dir)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
