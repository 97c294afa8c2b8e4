"""Lakes written from the fixture, for operators that need files.

Each is written once per session and scale factor, in the shared workspace. Queries that change a
lake redirect their models to a sandbox of their own.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from gallery import fixture
from gallery.common import once
from tripmart.operators.sinks import replace_file, write_lake
from tripmart.paths import PARTITION, raw_path, under
from tripmart.plans.flows import POLYGONS
from tripmart.plans.registry import STAGED_SERVICES, SUMMARY_MARTS, TRIP_MARTS, Lake
from tripmart.plans.staging import SERVICES
from tripmart.sources.polygons import zone_geometry
from tripmart.workspace import new_workspace


def land_weather(hours: DataFrame, base: str) -> None:
    """One file per day; a day has 24 rows."""
    hours.repartition(PARTITION).write.mode("overwrite").partitionBy(PARTITION).json(under(base, raw_path("weather")))


def land_zones(lookup: DataFrame, base: str) -> None:
    location = under(base, raw_path("reference/taxi_zone_lookup"))
    lookup.coalesce(1).write.mode("overwrite").option("header", True).csv(location)


def landed(spark: SparkSession, sf_dir: str, faultless: bool = False) -> str:
    """Raw files of all services, weather and zones, and the staged polygons."""

    def write(base: str) -> None:
        lines = fixture.stored_lines(spark, sf_dir)

        def land(service: str) -> None:
            own = fixture.lines_by_month(lines, service, faultless)
            rows = fixture.raw_trips(spark, sf_dir, service, faultless, own)
            write_lake(rows, under(base, raw_path(service)))

        with ThreadPoolExecutor(len(SERVICES)) as pool:
            list(pool.map(land, SERVICES))
        land_weather(fixture.raw_weather(spark, sf_dir, faultless), base)
        land_zones(fixture.raw_zone_lookup(spark, sf_dir), base)
        published = fixture.published_zones(spark, sf_dir, faultless)
        replace_file(zone_geometry(published), under(base, POLYGONS))

    return once(spark, sf_dir, f"landed-{faultless}", write)


def sandbox(spark: SparkSession, sf_dir: str, faultless: bool = True) -> Lake:
    """Landed files, with models of its own."""
    return Lake(spark, landed(spark, sf_dir, faultless), new_workspace(spark))


def build_all_staging(lake: Lake) -> None:
    """Without the gates."""
    lake.build("stg_taxi_zone_lookup")
    lake.side_by_side(lake.build, ["stg_weather", *STAGED_SERVICES])


def staged_lake(spark: SparkSession, sf_dir: str, faultless: bool = False) -> Lake:
    """All staging tables stored. To be read only."""
    source = landed(spark, sf_dir, faultless)

    def write(base: str) -> None:
        lake = Lake(spark, source, base)
        build_all_staging(lake)

    return Lake(spark, source, once(spark, sf_dir, f"staged-{faultless}", write))


def built_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """All final tables stored too, without the gates. To be read only."""
    lake = staged_lake(spark, sf_dir)

    def write(_: str) -> None:
        for wave in (TRIP_MARTS, SUMMARY_MARTS):
            lake.side_by_side(lake.build, wave)

    once(spark, sf_dir, "built", write)
    return lake
