"""Declared schemas: what raw files are read as, and what staging and final hold."""

from __future__ import annotations

# The column names of the published files. Types are the widest a month uses.
RAW = {
    "yellow_taxi": (
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, RatecodeID double, "
        "store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint, "
        "payment_type bigint, fare_amount double, extra double, mta_tax double, "
        "tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double, Airport_fee double"
    ),
    "green_taxi": (
        "VendorID bigint, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "store_and_fwd_flag string, RatecodeID double, PULocationID bigint, DOLocationID bigint, "
        "passenger_count double, trip_distance double, fare_amount double, extra double, "
        "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, payment_type double, trip_type double, congestion_surcharge double"
    ),
    "app_rides": (
        "dispatching_base_num string, pickup_datetime timestamp_ntz, "
        "dropOff_datetime timestamp_ntz, PUlocationID double, DOlocationID double, "
        "SR_Flag string, Affiliated_base_number string"
    ),
    "high_volume_fhv": (
        "hvfhs_license_num string, dispatching_base_num string, originating_base_num string, "
        "request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz, "
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID bigint, "
        "DOLocationID bigint, trip_miles double, trip_time bigint, base_passenger_fare double, "
        "tolls double, bcf double, sales_tax double, congestion_surcharge double, "
        "airport_fee double, tips double, driver_pay double, shared_request_flag string, "
        "shared_match_flag string, access_a_ride_flag string, wav_request_flag string, "
        "wav_match_flag string"
    ),
}

HOURLY_VARIABLES = {
    "temperature_2m": "double",
    "relative_humidity_2m": "int",
    "apparent_temperature": "double",
    "precipitation": "double",
    "wind_speed_10m": "double",
    "wind_direction_10m": "int",
    "weather_code": "int",
}
RAW_WEATHER = "time string, " + ", ".join(f"{n} {t}" for n, t in HOURLY_VARIABLES.items())
WEATHER_PAYLOAD = (
    "hourly struct<time: array<string>, "
    + ", ".join(f"{n}: array<{t}>" for n, t in HOURLY_VARIABLES.items())
    + ">"
)
RAW_ZONE_LOOKUP = "LocationID int, Borough string, Zone string, service_zone string"

_ZONES = "pickup_zone string, pickup_borough string, dropoff_zone string, dropoff_borough string"
_TIMES = "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_duration_minutes double"
_CHARGES = (
    "payment_type_name string, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, "
    "congestion_surcharge double"
)
_RIDE = "passenger_count int, trip_distance_miles double, rate_code_name string, store_and_fwd_flag string"
_DATE = "partition_date date"

STAGING = {
    "yellow_taxi": (
        f"vendor_id int, vendor_name string, {_TIMES}, {_RIDE}, {_ZONES}, {_CHARGES}, "
        f"airport_fee double, total_amount double, {_DATE}"
    ),
    "green_taxi": (
        f"vendor_id int, vendor_name string, {_TIMES}, {_RIDE}, trip_type_name string, {_ZONES}, "
        f"{_CHARGES}, total_amount double, {_DATE}"
    ),
    "app_rides": (
        f"dispatching_base_num string, affiliated_base_num string, {_TIMES}, "
        f"shared_ride_flag string, {_ZONES}, {_DATE}"
    ),
    "high_volume_fhv": (
        "company_name string, dispatching_base_num string, originating_base_num string, "
        f"request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz, {_TIMES}, "
        f"trip_distance_miles double, trip_time_seconds int, {_ZONES}, "
        "base_passenger_fare double, tolls_amount double, black_car_fund double, "
        "sales_tax double, congestion_surcharge double, airport_fee double, tip_amount double, "
        "driver_pay double, shared_request_flag string, shared_match_flag string, "
        f"access_a_ride_flag string, wav_request_flag string, wav_match_flag string, {_DATE}"
    ),
    "weather": (
        "datetime timestamp_ntz, temperature_c double, apparent_temperature_c double, "
        "humidity_pct int, precipitation_mm double, wind_speed_kmh double, "
        f"wind_direction_deg int, weather_code int, weather_description string, {_DATE}"
    ),
    "taxi_zone_lookup": "location_id int, borough string, zone string, service_zone string",
    "taxi_zones_geo": (
        "location_id int, borough string, zone string, shape_area double, "
        "geometry_wkt string, geometry_json string"
    ),
}

FINAL = {
    "trips": (
        f"{_TIMES}, taxi_type string, {_ZONES}, trip_distance_miles double, "
        f"fare_amount double, passenger_count int, {_DATE}"
    ),
    "revenue": (
        "pickup_datetime timestamp_ntz, pickup_zone string, pickup_borough string, "
        f"taxi_type string, fare_amount double, tip_amount double, total_amount double, {_DATE}"
    ),
    "weather_impact": (
        "date date, taxi_type string, fare_amount double, weather_description string, "
        f"avg_temperature_c double, total_precipitation_mm double, avg_wind_speed_kmh double, {_DATE}"
    ),
    "trips_hourly": (
        "pickup_hour timestamp_ntz, taxi_type string, pickup_borough string, "
        "pickup_zone string, trips bigint, revenue double, fare_trips bigint, "
        f"distance_miles double, duration_minutes_with_distance double, {_DATE}"
    ),
    "weather_daily": (
        "date date, day_type string, weather_description string, avg_temperature_c double, "
        "total_precipitation_mm double, avg_wind_speed_kmh double, trips bigint"
    ),
    "zones_geo": (
        "location_id int, borough string, zone string, geometry_json string, "
        "trip_count bigint, total_revenue double, avg_fare double"
    ),
}

# What the small marts keep of a month
SUMMARIES = {
    "monthly_days": (
        "date date, weather_description string, avg_temperature_c double, "
        f"total_precipitation_mm double, avg_wind_speed_kmh double, trips bigint, {_DATE}"
    ),
    "monthly_zone_revenue": f"pickup_zone string, trips bigint, revenue double, priced_trips bigint, {_DATE}",
}
