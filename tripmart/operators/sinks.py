"""Writing tables: whole, or some months of them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.paths import PARTITION, parse_months
from tripmart.sources.lake import in_months, read_lake

def write_lake(
    df: DataFrame,
    location: str,
    partition_by: str | None = PARTITION,
    months: str | date | Iterable[str | date] | None = None,
    regroup: bool = False,
    clear: bool = False,
) -> None:
    """Write a table as Parquet.

    - No months: the folder is cleared first, so a month that left the source does not linger.
    - Months: only these are computed, and each replaces its own folder. One job does them all.
      A month that now has no rows keeps its old folder. With `clear` the folder is cleared all
      the same, for tables that are published from it later.
    - Unpartitioned tables are always written whole, as one file: they hold a row per day or
      per zone. These few rows are moved to one task after the aggregation that makes them, which
      itself stays spread out (`coalesce` would pull it into that task).

    Trips are written where they were read: tasks already hold one month's rows, so there is no
    shuffle. `regroup` is for tables that come out of an aggregation with months spread over all
    tasks; adaptive execution then sizes the output, splitting a month that is too big for one.
    """
    if partition_by is None:
        df.repartition(1).write.mode("overwrite").parquet(location)
        return
    chosen = parse_months(months)
    df = in_months(df, chosen)
    if regroup:
        df = df.hint("rebalance", F.col(partition_by))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if chosen and not clear else "static")
        .partitionBy(partition_by)
        .parquet(location)
    )


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _replace_folder(spark: SparkSession, fs, new, live) -> None:
    """`live` becomes `new`. The former folder is put aside first, under a name that readers skip."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    aside = path(live.getParent(), f"_replaced-{uuid.uuid4().hex}")
    held = fs.exists(live)
    if held:
        _move(fs, live, aside)
    try:
        _move(fs, new, live)
    except Exception:
        if held:
            _move(fs, aside, live)
        raise
    if held:
        fs.delete(aside, True)


def publish(spark: SparkSession, pending: str, location: str, by_month: bool) -> None:
    """Put a table built and tested at `pending` in the place of the live one.

    With `by_month` each month that was built replaces its own folder and all others stay; else the
    whole table is replaced. Only folders are moved: no row is read or written again, and files keep the
    time at which they were written. A driver that fails in between leaves a month to build again.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(pending), path(location)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target if by_month else target.getParent())
    if by_month:
        for status in fs.globStatus(path(source, f"{PARTITION}=*")):
            _replace_folder(spark, fs, status.getPath(), path(target, status.getPath().getName()))
        fs.delete(source, True)
    else:
        _replace_folder(spark, fs, source, target)
    spark.catalog.refreshByPath(location)


def publish_view(spark, location: str, name: str, schema: str | None = None) -> DataFrame:
    """A temporary view over the written files, for later models and checks."""
    df = read_lake(spark, location, schema)
    df.createOrReplaceTempView(name)
    return df


def replace_file(df: DataFrame, location: str) -> None:
    """An unpartitioned table: one file, always replaced."""
    write_lake(df, location, partition_by=None)
