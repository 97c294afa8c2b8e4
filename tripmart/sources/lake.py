"""Reading what the lake holds, and listing it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.paths import PARTITION, parse_months


def month_folders(location: str, months: list[str]) -> str:
    """A path pattern for the folders of some months; one that is not there is passed over."""
    return f"{location.rstrip('/')}/{PARTITION}={{{','.join(months)}}}"


def _not_found(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_lake(
    spark: SparkSession, location: str, schema: str | None = None, months=None
) -> DataFrame:
    """A stored table: a folder of months, or one unpartitioned folder or file.

    With a declared schema no file is opened before the query runs. With months only their folders
    are listed, so a build of one month does not pay for the length of the history.
    """
    months = parse_months(months)
    reader = spark.read.schema(schema) if schema else spark.read
    if not months:
        return reader.parquet(location)
    try:
        found = reader.option("basePath", location).parquet(month_folders(location, months))
    except AnalysisException as error:
        if not (_not_found(error) and schema):
            raise
        return spark.createDataFrame([], declared(schema))
    return in_months(found, months)


def in_months(df: DataFrame, months: list[str] | None) -> DataFrame:
    """Only the given months; the filter reaches the scan as a partition filter."""
    if not months:
        return df
    return df.where(F.col(PARTITION).isin([date.fromisoformat(m) for m in months]))


def _found(spark: SparkSession, pattern: str) -> list:
    """Name, path, write time and kind of what matches a path pattern, hidden names aside."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    rows = [(s.getPath().getName(), s.getPath().toString(), s) for s in matches or []]
    return [row for row in rows if not row[0].startswith(("_", "."))]


def list_files(
    spark: SparkSession, location: str, months: list[str] | None = None
) -> DataFrame:
    """Month, path and write time of each data file.

    Spark's own lister walks the folders, on the executors where there are many; write times are
    read where the listed files are dealt out, so nothing passes file by file through the driver.
    """
    months = parse_months(months)
    pattern = month_folders(location, months) if months else location
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    except AnalysisException as error:
        if not _not_found(error):
            raise
        return spark.createDataFrame([], f"{PARTITION} date, path string, modified timestamp")
    day = F.regexp_extract("path", f"/{PARTITION}=([^/]+)/", 1)
    return found.where(day != "").select(
        day.cast("date").alias(PARTITION), "path", F.col("modificationTime").alias("modified")
    )


def partition_times(
    spark: SparkSession, location: str, months: list[str] | None = None
) -> DataFrame:
    """Month -> when its newest file was written. One row per month."""
    return list_files(spark, location, months).groupBy(PARTITION).agg(F.max("modified").alias("modified"))


def list_partitions(spark: SparkSession, location: str) -> list[str]:
    """The months a table holds, in order. A few hundred values at most."""
    found = list_files(spark, location).select(PARTITION).distinct().collect()
    return sorted(row[PARTITION].isoformat() for row in found)


def counted_by_footers(
    spark: SparkSession, location: str, schema: str, months: list[str] | None = None, columns: Iterable[str] = ()
) -> DataFrame:
    """Rows of each month and non-NULL values of some columns, as a plan that reads no data page.

    Parquet footers hold these counts, and Spark's second-generation reader answers counts by
    partition from them. That reader is switched on in a session of its own, so the result can only
    be collected. Columns are found by their place: `schema` must list all columns of the files in
    order, as it does for tables written here. Row counts need no more than one column of it.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    paths = [f"{location.rstrip('/')}/{PARTITION}={m}" for m in parse_months(months)] or [location]
    rows = other.read.schema(schema).option("basePath", location).parquet(*paths)
    counts = [F.count(c).alias(c) for c in columns]
    return rows.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("row_count"), *counts)


def footer_counts(
    spark: SparkSession, location: str, schema: str, months: list[str] | None = None, columns: Iterable[str] = ()
) -> DataFrame:
    """The rows of `counted_by_footers`, one per month. The months must exist."""
    columns = list(columns)
    found = counted_by_footers(spark, location, schema, months, columns)
    rows = [tuple(row) for row in found.collect()]
    return spark.createDataFrame(rows, ", ".join([f"{PARTITION} date, row_count bigint", *[f"`{c}` bigint" for c in columns]]))


def path_exists(spark: SparkSession, location: str) -> bool:
    """Whether there is a file, or a folder that holds something."""
    return any(s.isFile() or _found(spark, f"{path}/*") for _, path, s in _found(spark, location))


@lru_cache(maxsize=None)
def declared(schema: str) -> T.StructType:
    """A DDL text of `tripmart.sources.schemas`, parsed once."""
    return T.StructType.fromDDL(schema)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the declared columns and types, in the declared order."""
    return df.selectExpr(
        *[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in declared(schema)]
    )
