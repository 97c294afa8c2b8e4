"""Reshaping the weather service's answer, whose hours come as parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources import schemas


def read_weather_payload(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(location)


def hourly_rows(payload: DataFrame) -> DataFrame:
    """One row per hour. Hours end with the shortest array, as nothing fills the rest."""
    names = ["time", *schemas.HOURLY_VARIABLES]
    arrays = [F.col(f"hourly.{name}") for name in names]
    hours = F.least(*[F.size(a) for a in arrays])
    cut = [F.slice(a, F.lit(1), hours).alias(name) for a, name in zip(arrays, names)]
    others = [c for c in payload.columns if c != "hourly"]
    return payload.select(*others, F.inline(F.arrays_zip(*cut)))
