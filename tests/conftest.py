import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("seriesmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def sales_frame(spark, rows):
    """rows of (ISO day or None, store, item, sales)"""
    df = spark.createDataFrame(rows, "date STRING, store INT, item INT, sales BIGINT")
    return df.withColumn("date", df["date"].cast("date"))


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
