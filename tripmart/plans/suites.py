"""The declared tests of every table. They are part of the data contract."""

from __future__ import annotations

from tripmart.functions.codes import COMPANIES
from tripmart.operators.checks import WARN, Check
from tripmart.operators.quality import USUAL, Limits
from tripmart.paths import PARTITION

LOOKUP = "taxi_zone_lookup"


def required(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def within(column: str, minimum: float | None = None, maximum: float | None = None) -> Check:
    return Check("accepted_range", column, arguments={"minimum": minimum, "maximum": maximum})


def listed(column: str, *values: str) -> Check:
    return Check("accepted_values", column, arguments={"values": list(values)})


def known_zone(column: str) -> Check:
    return Check("relationships", column, arguments={"to": LOOKUP, "field": "LocationID"})


def _raw_suite(keys: list[str], zone_ids: tuple[str, str], zones_required: bool) -> list[Check]:
    """Keys there, zone ids that exist, a usual number of rows per month."""
    checks = [*required(PARTITION, *keys), Check("partition_volume", PARTITION)]
    for zone_id in zone_ids:
        checks += (required(zone_id) if zones_required else []) + [known_zone(zone_id)]
    return checks


_IDS = ("PULocationID", "DOLocationID")

RAW = {
    "yellow_taxi": _raw_suite(["tpep_pickup_datetime", "tpep_dropoff_datetime"], _IDS, True),
    "green_taxi": _raw_suite(["lpep_pickup_datetime", "lpep_dropoff_datetime"], _IDS, True),
    # Most of these records carry no zone; repeated records are known and only warned about
    "app_rides": [
        Check("no_duplicate_rows", severity=WARN),
        *_raw_suite(
            ["pickup_datetime", "dropOff_datetime", "dispatching_base_num"],
            ("PUlocationID", "DOlocationID"),
            False,
        ),
    ],
    "high_volume_fhv": _raw_suite(
        ["hvfhs_license_num", "pickup_datetime", "dropoff_datetime"], _IDS, True
    ),
    "taxi_zone_lookup": [*required("LocationID"), Check("unique", "LocationID")],
}

_STAGED_TIMES = [
    *required("pickup_datetime", "dropoff_datetime"),
    within("trip_duration_minutes", 0),
]
_STAGED_ENDS = required("pickup_borough", PARTITION)
_TAXI = [
    *_STAGED_TIMES,
    within("trip_distance_miles", 0),
    within("fare_amount", 0),
    *_STAGED_ENDS,
]

STAGING = {
    "yellow_taxi": _TAXI,
    "green_taxi": _TAXI,
    "app_rides": [*required("dispatching_base_num"), *_STAGED_TIMES, *_STAGED_ENDS],
    "high_volume_fhv": [
        *required("company_name"),
        listed("company_name", *COMPANIES.values()),
        *_STAGED_TIMES,
        within("trip_distance_miles", 0),
        within("base_passenger_fare", 0),
        *_STAGED_ENDS,
    ],
    "weather": [
        *required("datetime"),
        Check("unique", "datetime"),
        within("humidity_pct", 0, 100),
        within("precipitation_mm", 0),
        *required("weather_code", "weather_description", PARTITION),
    ],
    "taxi_zone_lookup": [
        *required("location_id"),
        Check("unique", "location_id"),
        *required("borough", "zone"),
    ],
}


def trip_tests(limits: Limits) -> list[Check]:
    return [
        *required("taxi_type"),
        listed("taxi_type", "yellow_taxi", "green_taxi", "app_rides", "high_volume_fhv"),
        *required("pickup_datetime", "pickup_borough"),
        within("trip_duration_minutes", limits.min_minutes, limits.max_minutes),
        within("trip_distance_miles", 0, limits.max_miles),
        # Tips come on top of the capped fare, so there is no upper bound
        within("fare_amount", 0),
    ]


FINAL = {
    "trips": trip_tests(USUAL),
    "revenue": [*required("pickup_zone", "total_amount"), within("total_amount", 0)],
    "weather_impact": required("date", "taxi_type"),
    "zones_geo": [
        *required("location_id"),
        Check("unique", "location_id"),
        *required("geometry_json"),
    ],
    "trips_hourly": [*required("pickup_hour"), within("trips", 1)],
    "weather_daily": [
        *required("date"),
        Check("unique", "date"),
        listed("day_type", "Weekday", "Weekend"),
    ],
}


def final(limits: Limits = USUAL) -> dict[str, list[Check]]:
    """The tests of the final tables, of a build with these limits."""
    return FINAL if limits == USUAL else {**FINAL, "trips": trip_tests(limits)}
