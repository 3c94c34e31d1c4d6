"""CSV reads that a file has to earn: header names are checked and bad rows set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.sources.contract import SALES_CONTRACT, Contract

RAW = "_corrupt_record"


def read_sales_csv(
    spark: SparkSession, path: str, contract: Contract = SALES_CONTRACT
) -> tuple[DataFrame, DataFrame]:
    """Good rows in the contract's types, and bad rows with their raw text and ``_rule``.

    Spark matches a CSV schema by position, so a file with one more leading column would load
    shifted without a word. Here its header is compared with the contract and the read fails.
    Every column is parsed whatever the query selects; otherwise the rows that count as malformed
    would depend on the columns that happen to be used.
    """
    rows = (
        spark.read.schema(f"{contract.ddl}, {RAW} STRING")
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RAW)
        .option("columnPruning", False)
        .csv(path)
    )
    rule = F.when(F.col(RAW).isNotNull(), F.lit("malformed")).otherwise(contract.first_broken_rule())
    checked = rows.withColumn("_rule", rule)
    good = checked.where(F.col("_rule").isNull()).select(*[c.name for c in contract.columns])
    bad = checked.where(F.col("_rule").isNotNull())
    return good, bad
