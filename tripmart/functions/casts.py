"""Casts whose results differ between Spark and the lake's published values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def to_int(column: Column, data_type: T.DataType) -> Column:
    """INT by rounding halves to even; Spark's own cast would cut the fraction off."""
    if isinstance(data_type, FRACTIONAL):
        return F.rint(column).cast("int")
    if isinstance(data_type, T.DecimalType):
        # Decimals round halves away from zero
        return F.round(column, 0).cast("int")
    return column.cast("int")


def int_column(df: DataFrame, name: str) -> Column:
    """`to_int` of a named column, by the type it has in `df`."""
    return to_int(F.col(name), df.schema[name].dataType)


def to_double(name: str) -> Column:
    return F.col(name).cast("double")


def to_text(name: str) -> Column:
    return F.col(name).cast("string")


def to_wall_clock(name: str) -> Column:
    """Timestamp without a zone; also parses `2025-01-01T00:00`."""
    return F.col(name).cast("timestamp_ntz")


def to_day(column: Column) -> Column:
    return column.cast("date")
