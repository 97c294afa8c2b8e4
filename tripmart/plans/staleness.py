"""Which months a layer has to rebuild, worked out from the files' write times."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.paths import PARTITION
from tripmart.sources.lake import partition_times


def stale_months(
    sources: list[DataFrame], targets: list[DataFrame], full_refresh: bool = False
) -> DataFrame:
    """Months of any source that some target lacks or wrote before the source did.

    All inputs hold (month, write time), one row per month. Equal times count as fresh.
    """
    newest = (
        reduce(DataFrame.unionByName, sources)
        .groupBy(PARTITION)
        .agg(F.max("modified").alias("source_time"))
    )
    if full_refresh or not targets:
        return newest.select(PARTITION).orderBy(PARTITION)
    built = (
        reduce(DataFrame.unionByName, targets)
        .groupBy(PARTITION)
        .agg(F.count(F.lit(1)).alias("n_built"), F.min("modified").alias("oldest_target"))
    )
    lacking = F.coalesce(F.col("n_built"), F.lit(0)) < len(targets)
    older = F.col("oldest_target") < F.col("source_time")
    return (
        newest.join(built, PARTITION, "left")
        .where(lacking | older)
        .select(PARTITION)
        .orderBy(PARTITION)
    )


def plan_months(
    spark: SparkSession, sources: list[str], targets: list[str], full_refresh: bool = False
) -> list[str]:
    """The stale months of stored tables, from listings only, which run side by side."""
    with ThreadPoolExecutor(len(sources) + len(targets)) as pool:
        times = list(pool.map(lambda table: partition_times(spark, table), [*sources, *targets]))
    stale = stale_months(times[: len(sources)], times[len(sources) :], full_refresh)
    return [row[0].isoformat() for row in stale.collect()]
