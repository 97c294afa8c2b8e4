"""A small valid lake: three months of all services, with weather and zones."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.sinks import replace_file
from tripmart.paths import raw_path, under
from tripmart.plans.flows import POLYGONS
from tripmart.plans.registry import Lake
from tripmart.plans.staging import SERVICES
from tripmart.sources import schemas
from tripmart.sources.lake import conform
from tripmart.sources.polygons import zone_geometry

MONTHS = ("2025-01-01", "2025-02-01", "2025-03-01")
ROWS = 40

_VALUES = {
    "VendorID": "1 + id % 2",
    "passenger_count": "1 + id % 3",
    "trip_distance": "1 + id % 20",
    "trip_miles": "1 + id % 20",
    "RatecodeID": "1 + id % 6",
    "store_and_fwd_flag": "'N'",
    "PULocationID": "1 + id % 4",
    "DOLocationID": "1 + id % 3",
    "payment_type": "id % 7",
    "trip_type": "1 + id % 2",
    "fare_amount": "10 + id % 50",
    "base_passenger_fare": "10 + id % 50",
    "total_amount": "15 + id % 50",
    "tip_amount": "if(id % 3 = 0, null, 2.5)",
    "tips": "if(id % 3 = 0, null, 2.5)",
    "hvfhs_license_num": "concat('HV000', 2 + id % 4)",
    "dispatching_base_num": "concat('B', id % 9)",
    "trip_time": "600 + id % 100",
}


def raw_month(spark: SparkSession, service: str, month: str, rows: int = ROWS) -> DataFrame:
    columns = []
    wanted = f"{schemas.RAW[service]}, partition_date date"
    for name in [part.split()[0] for part in schemas.RAW[service].split(",")]:
        lowered = name.lower()
        if lowered.endswith("pickup_datetime"):
            value = f"timestamp_ntz'{month} 00:30:00' + make_dt_interval(cast(id % 28 as int), cast(id % 24 as int))"
        elif lowered.endswith("dropoff_datetime"):
            value = (
                f"timestamp_ntz'{month} 00:30:00' + make_dt_interval(cast(id % 28 as int), "
                "cast(id % 24 as int), cast(10 + id % 50 as int), cast(id % 60 as int))"
            )
        else:
            named = {k.lower(): v for k, v in _VALUES.items()}
            value = named.get(lowered, "null")
        columns.append(f"{value} AS `{name}`")
    df = spark.range(rows).selectExpr(*columns, f"date'{month}' AS partition_date")
    return conform(df, wanted)


def land_month(spark, base, service, month, rows: int = ROWS, change=None) -> None:
    df = raw_month(spark, service, month, rows)
    df = change(df) if change else df
    folder = under(base, raw_path(service, month))
    df.drop("partition_date").coalesce(1).write.mode("overwrite").parquet(folder)


def land_day(base, day: date, rain: float = 0.0) -> None:
    import pathlib

    folder = pathlib.Path(under(base, raw_path("weather", day.isoformat())))
    folder.mkdir(parents=True, exist_ok=True)
    hours = [
        {
            "time": f"{day.isoformat()}T{h:02d}:00",
            "temperature_2m": 5.5,
            "relative_humidity_2m": 60,
            "apparent_temperature": 3.0,
            "precipitation": rain / 24,
            "wind_speed_10m": 10.0,
            "wind_direction_10m": 180,
            "weather_code": 61 if rain else 0,
        }
        for h in range(24)
    ]
    (folder / "w.json").write_text("".join(json.dumps(h) + "\n" for h in hours))


def land_zones(spark, base) -> None:
    rows = [(n, f"Borough {n % 2}", f"Zone {n}", "Yellow Zone") for n in range(1, 6)]
    lookup = spark.createDataFrame(rows, schemas.RAW_ZONE_LOOKUP)
    location = under(base, raw_path("reference/taxi_zone_lookup"))
    lookup.coalesce(1).write.mode("overwrite").option("header", True).csv(location)


def published_zones(spark) -> DataFrame:
    ring = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'
    rows = [(n, f"Borough {n % 2}", f"Zone {min(n, 4)}", 1.0, ring) for n in range(1, 6)]
    return spark.createDataFrame(
        rows, "LocationID int, borough string, zone string, Shape_Area double, geometry string"
    )


def make_lake(spark, base: str, months=MONTHS, weather_days: int = 90) -> Lake:
    for service in SERVICES:
        for month in months:
            land_month(spark, base, service, month)
    first = date.fromisoformat(MONTHS[0])
    for n in range(weather_days):
        land_day(base, first + timedelta(days=n), rain=float(n % 4 * 6))
    land_zones(spark, base)
    replace_file(zone_geometry(published_zones(spark)), under(base, POLYGONS))
    return Lake(spark, base)
