"""Saved tables: write modes, partitions that can be written twice, and versions of a growing table.

A table is named either by its catalog name or by a path (anything with a slash), and is stored
as Parquet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from seriesmill.operators.quality import dedup
from seriesmill.session import shared_folder

VERSION = "arrival_version"
#: Where the tables of ``materialise`` lie.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    """Whether there is such a table. Any other failure to read it is an error, not a missing table."""
    try:
        read_table(spark, target)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return False
        raise
    return True


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """Resolve the table anew, so that files written since the last read are seen."""
    if _is_path(target):
        return spark.read.parquet(target)
    spark.catalog.refreshTable(target)
    return spark.table(target)


def save(
    df: DataFrame,
    target: str,
    path: str | None = None,
    mode: str = "error",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Write a whole table; ``mode`` says what happens if it exists, and an existing one is an error by default.

    A catalog table is external if it is given a ``path``. ``bucket_by`` (number, columns) stores a
    catalog table by the hash of its series: jobs that group by those columns then need no shuffle,
    which pays for a sales table that is read for every retraining. The rows are spread by bucket
    first, so that each bucket becomes one file.
    """
    if bucket_by is not None:
        number, columns = bucket_by
        df = df.repartition(number, *columns)
    writer = df.write.mode(mode).format("parquet")
    if bucket_by is not None:
        writer = writer.bucketBy(number, *columns).sortBy(*columns)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For an intermediate that several branches of a plan need: each would otherwise repeat its scans,
    since filters that Spark infers differ from branch to branch and keep it from reusing a shuffle.
    The written table outlives lost executors. It stays until ``discard``.
    """
    path = shared_folder(df.sparkSession, purpose)
    save(df, path)
    out = read_table(df.sparkSession, path)
    _FOLDERS[out] = path
    return out


def same_folder(view: DataFrame, table: DataFrame) -> DataFrame:
    """``view`` of a materialised ``table``, which ``discard`` then takes for it."""
    if table in _FOLDERS:
        _FOLDERS[view] = _FOLDERS[table]
    return view


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these; nothing that is still to be computed may read it.

    A table that was not materialised, or is gone, is left alone.
    """
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _only_named_partitions(spark: SparkSession) -> Iterator[None]:
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def save_partition(df: DataFrame, target: str, by: str) -> None:
    """Write the partitions that ``df`` holds and leave all others alone. A second write leaves no duplicates.

    The rebalance hint lets adaptive execution merge small pieces into few files per partition and
    split a partition that is much larger than the others.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != by] + [by]
    rows = df.select(*columns).hint("rebalance", by)
    if _is_path(target):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(target)
    elif spark.catalog.tableExists(target):
        # insertInto takes the mode from the session only.
        with _only_named_partitions(spark):
            rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    else:
        rows.write.partitionBy(by).format("parquet").saveAsTable(target)


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    spark.sql(f"USE `{name}`")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists. A managed table takes its files with it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def history(df: DataFrame) -> DataFrame:
    """What each version brought: arrival_version, n_rows, min_date, max_date."""
    return df.groupBy(F.col(VERSION).cast("bigint").alias(VERSION)).agg(
        F.count("*").alias("n_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def latest_version(df: DataFrame) -> DataFrame:
    return df.agg(F.max(VERSION).alias(VERSION))


def snapshot(df: DataFrame, version: int, keys: Sequence[str] = ("date", "store", "item")) -> DataFrame:
    """The sales known at a version: of each key the row of the newest version up to it.

    Later partitions are pruned. A partition that was delivered again stands as delivered last.
    """
    return newest_version(df.where(F.col(VERSION) <= version), keys)


def newest_version(df: DataFrame, keys: Sequence[str] = ("date", "store", "item")) -> DataFrame:
    """Of each key the row of its newest version.

    Version 0, the long history, has each key once: only later versions are searched for copies,
    and the history loses the keys that they hold.
    """
    later = dedup(df.where(F.col(VERSION) > 0), keys, [VERSION])
    same = [df[k].eqNullSafe(F.col(f"_later_{k}")) for k in keys]
    held = later.select(*[F.col(k).alias(f"_later_{k}") for k in keys])
    return df.where(F.col(VERSION) == 0).join(held, same, "left_anti").unionByName(later)


def version_changes(df: DataFrame, older: int, newer: int, keys: Sequence[str] = ("date", "store", "item")) -> DataFrame:
    """keys, change, before, after: what the versions after ``older`` up to ``newer`` did to the sales.

    A key is added, changed (other sales) or removed (its newest row has no sales); one that was
    delivered again as it stood is no change. Only partitions up to ``newer`` are read, and of those
    up to ``older`` only the keys that came again.
    """
    later = newest_version(df.where((F.col(VERSION) > older) & (F.col(VERSION) <= newer)), keys)
    touched = later.select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.col("sales").alias("after"))
    known = df.where(F.col(VERSION) <= older)
    again = known.join(touched, [known[k].eqNullSafe(touched[f"_new_{k}"]) for k in keys], "left_semi")
    old = newest_version(again, keys).select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.col("sales").alias("before"), F.lit(True).alias("_known"))
    joined = touched.join(old, [touched[f"_new_{k}"].eqNullSafe(old[f"_old_{k}"]) for k in keys], "left")
    had = F.col("_known").isNotNull() & F.col("before").isNotNull()
    change = F.when(had & F.col("after").isNull(), "removed").when(~had & F.col("after").isNotNull(), "added")
    change = change.when(had & ~F.col("before").eqNullSafe(F.col("after")), "changed")
    return joined.select(*[F.col(f"_new_{k}").alias(k) for k in keys], change.alias("change"), "before", "after").where("change IS NOT NULL")
