"""Raw records to typed, translated, zone-enriched staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.casts import int_column, to_double, to_int, to_text, to_wall_clock
from tripmart.functions.clock import elapsed_minutes
from tripmart.functions.codes import (
    COMPANIES,
    PAYMENT_TYPES,
    RATE_CODES,
    TRIP_TYPES,
    VENDORS,
    WEATHER_CODES,
    translate,
)
from tripmart.operators.dimensions import with_zones
from tripmart.operators.quality import positive, present, times_in_order, unknown_or_positive
from tripmart.paths import PARTITION
from tripmart.sources.lake import conform
from tripmart.sources.schemas import RAW, STAGING

ZONE_IDS = ("pickup_id", "dropoff_id")


def _keyed(raw: DataFrame, service: str, pickup: str, dropoff: str, ids: tuple[str, str]) -> DataFrame:
    """Declared raw columns plus typed times and zone ids under common names.

    Other columns of the files may be named like these or like staged ones, so they end here.
    """
    declared = {part.split()[0].lower() for part in RAW[service].split(",")} | {PARTITION}
    return raw.select(
        *[raw[name] for name in raw.columns if name.lower() in declared],
        to_wall_clock(pickup).alias("pickup_at"),
        to_wall_clock(dropoff).alias("dropoff_at"),
        int_column(raw, ids[0]).alias(ZONE_IDS[0]),
        int_column(raw, ids[1]).alias(ZONE_IDS[1]),
    )


def _times() -> list[Column]:
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    return [
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        elapsed_minutes(pickup, dropoff).alias("trip_duration_minutes"),
    ]


def _taxi(raw: DataFrame, lookup: DataFrame, service: str, extra: list[Column]) -> DataFrame:
    """Yellow and green share all but the time prefix and one column."""
    prefix = {"yellow_taxi": "tpep", "green_taxi": "lpep"}[service]
    keyed = _keyed(
        raw,
        service,
        f"{prefix}_pickup_datetime",
        f"{prefix}_dropoff_datetime",
        ("PULocationID", "DOLocationID"),
    ).withColumns(
        {
            "passengers": int_column(raw, "passenger_count"),
            "vendor": int_column(raw, "VendorID"),
            "rate_code": int_column(raw, "RatecodeID"),
            "payment": int_column(raw, "payment_type"),
        }
    )
    kept = keyed.where(
        times_in_order("pickup_at", "dropoff_at")
        & present(*ZONE_IDS)
        & positive("trip_distance", "fare_amount", "total_amount")
        & unknown_or_positive(F.col("passengers"))
    )
    doubles = (
        "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
        "congestion_surcharge total_amount"
    ).split()
    typed = kept.select(
        F.col("vendor").alias("vendor_id"),
        translate("vendor", VENDORS).alias("vendor_name"),
        *_times(),
        F.col("passengers").alias("passenger_count"),
        to_double("trip_distance").alias("trip_distance_miles"),
        translate("rate_code", RATE_CODES).alias("rate_code_name"),
        to_text("store_and_fwd_flag").alias("store_and_fwd_flag"),
        translate("payment", PAYMENT_TYPES).alias("payment_type_name"),
        *[to_double(name).alias(name) for name in doubles],
        *extra,
        *ZONE_IDS,
        PARTITION,
    )
    return conform(with_zones(typed, lookup, *ZONE_IDS), STAGING[service])


def stage_yellow(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    return _taxi(raw, lookup, "yellow_taxi", [to_double("Airport_fee").alias("airport_fee")])


def stage_green(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    raw = raw.withColumn("trip_type", int_column(raw, "trip_type"))
    return _taxi(
        raw, lookup, "green_taxi", [translate("trip_type", TRIP_TYPES).alias("trip_type_name")]
    )


def stage_app_rides(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    keyed = _keyed(raw, "app_rides", "pickup_datetime", "dropOff_datetime", ("PUlocationID", "DOlocationID"))
    kept = keyed.where(
        times_in_order("pickup_at", "dropoff_at") & present("dispatching_base_num", *ZONE_IDS)
    )
    typed = kept.select(
        to_text("dispatching_base_num").alias("dispatching_base_num"),
        to_text("Affiliated_base_number").alias("affiliated_base_num"),
        *_times(),
        to_text("SR_Flag").alias("shared_ride_flag"),
        *ZONE_IDS,
        PARTITION,
    )
    return conform(with_zones(typed, lookup, *ZONE_IDS), STAGING["app_rides"])


def stage_high_volume(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    keyed = _keyed(raw, "high_volume_fhv", "pickup_datetime", "dropoff_datetime", ("PULocationID", "DOLocationID"))
    kept = keyed.where(
        times_in_order("pickup_at", "dropoff_at")
        & present(*ZONE_IDS)
        & positive("trip_miles", "base_passenger_fare")
    )
    renamed = {
        "base_passenger_fare": "base_passenger_fare",
        "tolls": "tolls_amount",
        "bcf": "black_car_fund",
        "sales_tax": "sales_tax",
        "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "airport_fee",
        "tips": "tip_amount",
        "driver_pay": "driver_pay",
    }
    texts = (
        "dispatching_base_num originating_base_num shared_request_flag shared_match_flag "
        "access_a_ride_flag wav_request_flag wav_match_flag"
    ).split()
    typed = kept.select(
        translate("hvfhs_license_num", COMPANIES).alias("company_name"),
        *[to_text(name).alias(name) for name in texts],
        to_wall_clock("request_datetime").alias("request_datetime"),
        to_wall_clock("on_scene_datetime").alias("on_scene_datetime"),
        *_times(),
        to_double("trip_miles").alias("trip_distance_miles"),
        int_column(raw, "trip_time").alias("trip_time_seconds"),
        *[to_double(old).alias(new) for old, new in renamed.items()],
        *ZONE_IDS,
        PARTITION,
    )
    return conform(with_zones(typed, lookup, *ZONE_IDS), STAGING["high_volume_fhv"])


def stage_weather(raw: DataFrame) -> DataFrame:
    coded = raw.withColumn("code", int_column(raw, "weather_code"))
    return conform(
        coded.select(
            to_wall_clock("time").alias("datetime"),
            to_double("temperature_2m").alias("temperature_c"),
            to_double("apparent_temperature").alias("apparent_temperature_c"),
            int_column(raw, "relative_humidity_2m").alias("humidity_pct"),
            to_double("precipitation").alias("precipitation_mm"),
            to_double("wind_speed_10m").alias("wind_speed_kmh"),
            int_column(raw, "wind_direction_10m").alias("wind_direction_deg"),
            F.col("code").alias("weather_code"),
            translate("code", WEATHER_CODES).alias("weather_description"),
            PARTITION,
        ),
        STAGING["weather"],
    )


def stage_zone_lookup(raw: DataFrame) -> DataFrame:
    kept = raw.where(present("LocationID", "Borough", "Zone"))
    return kept.select(
        to_int(F.col("LocationID"), raw.schema["LocationID"].dataType).alias("location_id"),
        to_text("Borough").alias("borough"),
        to_text("Zone").alias("zone"),
        to_text("service_zone").alias("service_zone"),
    )


STAGERS = {
    "yellow_taxi": stage_yellow,
    "green_taxi": stage_green,
    "app_rides": stage_app_rides,
    "high_volume_fhv": stage_high_volume,
}
SERVICES = tuple(STAGERS)
