"""Spark session with the settings the lake relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Nothing here fixes a cluster's size: AQE starts from the shuffle partitions and merges them
# by the advisory size. It splits skewed joins and rebalanced writes, never an aggregate's exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    # A staging task reads one or two months, so it can keep a writer open for each
    # instead of sorting its rows by month first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # The JVM never compiles a method beyond 8,000 bytes of code: a fused stage that long would be
    # interpreted row by row, so its operators run one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Those of them that tell how a plan is run, and can be set while a session runs
RUNTIME = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.codegen.hugeMethodLimit")


def tune(spark: SparkSession) -> None:
    """Give a session made elsewhere the `RUNTIME` settings that it does not set itself. No result depends on them."""
    for key in RUNTIME:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, SETTINGS[key])


def build_session(app_name: str = "tripmart", **extra: str) -> SparkSession:
    """A session with `SETTINGS`; `extra` uses `__` for dots (`spark__executor__memory`)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
