"""Helpers shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.rounding import round_half_away
from tripmart.workspace import new_workspace

KEYS = ("l_orderkey", "l_linenumber")

_WRITTEN: dict[tuple, str] = {}


def once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """The folder that `write` filled, once per session and scale factor."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _WRITTEN:
        base = new_workspace(spark)
        write(base)
        _WRITTEN[key] = base
    return _WRITTEN[key]


def to_six(column: Column) -> Column:
    """Sums of doubles depend on their order beyond this."""
    return round_half_away(column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: to_six(F.col(n)) for n in names})
