"""The six final tables, as functions of the staging tables (or of each other)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.clock import hour_start
from tripmart.functions.casts import to_day
from tripmart.functions.labels import day_type
from tripmart.functions.rounding import round_half_away
from tripmart.operators.dimensions import broadcast_if_small
from tripmart.operators.quality import USUAL, Limits, clean_trip, present
from tripmart.paths import PARTITION
from tripmart.sources.lake import conform
from tripmart.sources.schemas import FINAL

# What each service reports: the fare its limits apply to, and whether it has distances
RULES = {
    "yellow_taxi": {"fare": "total_amount", "has_distance": True},
    "green_taxi": {"fare": "total_amount", "has_distance": True},
    "app_rides": {"fare": None, "has_distance": False},
    "high_volume_fhv": {"fare": "base_passenger_fare", "has_distance": True},
}
METERED = ("yellow_taxi", "green_taxi")


def clean(staged: DataFrame, service: str, limits: Limits = USUAL) -> DataFrame:
    """Staged trips that pass the quality rules. Never stored: each mart reads what it needs."""
    return staged.where(clean_trip(**RULES[service], **asdict(limits)))


def stack(branches: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, branches)


def fare_with_tip() -> Column:
    return F.col("base_passenger_fare") + F.coalesce(F.col("tip_amount"), F.lit(0.0))


def whole_fare(service: str) -> Column:
    """What the passenger paid, tips included; unknown for app rides."""
    if service in METERED:
        return F.col("total_amount")
    if service == "high_volume_fhv":
        return fare_with_tip()
    return F.lit(None).cast("double")


def trips(staging: Mapping[str, DataFrame], limits: Limits = USUAL) -> DataFrame:
    branches = []
    for service in RULES:
        known = {
            "taxi_type": F.lit(service),
            "fare_amount": whole_fare(service),
            "trip_distance_miles": (
                F.col("trip_distance_miles") if RULES[service]["has_distance"] else F.lit(None)
            ),
            "passenger_count": F.col("passenger_count") if service in METERED else F.lit(None),
        }
        rows = clean(staging[service], service, limits).where(present("pickup_borough"))
        branches.append(conform(rows.withColumns(known), FINAL["trips"]))
    return stack(branches)


def revenue(staging: Mapping[str, DataFrame], limits: Limits = USUAL) -> DataFrame:
    branches = []
    for service in (*METERED, "high_volume_fhv"):
        metered = "fare_amount" if service in METERED else "base_passenger_fare"
        known = {
            "taxi_type": F.lit(service),
            "fare_amount": F.col(metered),
            "total_amount": whole_fare(service),
        }
        rows = clean(staging[service], service, limits).where(present("pickup_zone"))
        branches.append(conform(rows.withColumns(known), FINAL["revenue"]))
    return stack(branches)


def daily_weather(hourly: DataFrame) -> DataFrame:
    """One row per day; the description is the one at noon."""
    at_noon = F.when(F.hour("datetime") == 12, F.col("weather_description"))
    return hourly.groupBy(to_day(F.col("datetime")).alias("date")).agg(
        round_half_away(F.avg("temperature_c"), 1).alias("avg_temperature_c"),
        round_half_away(F.sum("precipitation_mm"), 1).alias("total_precipitation_mm"),
        round_half_away(F.avg("wind_speed_kmh"), 1).alias("avg_wind_speed_kmh"),
        F.max(at_noon).alias("weather_description"),
    )


def dated_fares(staging: Mapping[str, DataFrame], limits: Limits = USUAL) -> DataFrame:
    """Every clean trip's day and fare, whether or not its zone is known."""
    return stack(
        [
            clean(staging[service], service, limits).select(
                to_day(F.col("pickup_datetime")).alias("date"),
                F.lit(service).alias("taxi_type"),
                whole_fare(service).alias("fare_amount"),
                PARTITION,
            )
            for service in RULES
        ]
    )


def weather_impact(
    staging: Mapping[str, DataFrame], hourly: DataFrame, limits: Limits = USUAL
) -> DataFrame:
    days = broadcast_if_small(daily_weather(hourly))
    return conform(dated_fares(staging, limits).join(days, "date", "left"), FINAL["weather_impact"])


def trips_hourly(all_trips: DataFrame) -> DataFrame:
    """Additive measures per hour, service and pickup zone."""
    minutes = F.when(F.col("trip_distance_miles").isNotNull(), F.col("trip_duration_minutes"))
    grouped = all_trips.groupBy(
        hour_start(F.col("pickup_datetime")).alias("pickup_hour"),
        "taxi_type",
        "pickup_borough",
        "pickup_zone",
        PARTITION,
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_amount").alias("revenue"),
        F.count("fare_amount").alias("fare_trips"),
        F.sum("trip_distance_miles").alias("distance_miles"),
        F.sum(minutes).alias("duration_minutes_with_distance"),
    )
    return conform(grouped, FINAL["trips_hourly"])


# --- the small marts are folded from one summary per month ----------------------------------


def monthly_days(impact: DataFrame) -> DataFrame:
    """Per month and day, what `fold_days` needs: a month's files may hold days of another."""
    return impact.groupBy(PARTITION, "date").agg(
        F.max("weather_description").alias("weather_description"),
        F.max("avg_temperature_c").alias("avg_temperature_c"),
        F.max("total_precipitation_mm").alias("total_precipitation_mm"),
        F.max("avg_wind_speed_kmh").alias("avg_wind_speed_kmh"),
        F.count(F.lit(1)).alias("trips"),
    )


def fold_days(days: DataFrame) -> DataFrame:
    """`weather_daily` from the `monthly_days` of all months."""
    grouped = days.groupBy("date").agg(
        F.max("weather_description").alias("weather_description"),
        F.max("avg_temperature_c").alias("avg_temperature_c"),
        F.max("total_precipitation_mm").alias("total_precipitation_mm"),
        F.max("avg_wind_speed_kmh").alias("avg_wind_speed_kmh"),
        F.sum("trips").alias("trips"),
    )
    return conform(
        grouped.withColumn("day_type", day_type(F.col("date"))), FINAL["weather_daily"]
    )


def weather_daily(impact: DataFrame) -> DataFrame:
    return fold_days(monthly_days(impact))


def monthly_zone_revenue(all_revenue: DataFrame) -> DataFrame:
    """Per month and zone, sums and counts: means cannot be folded, these can."""
    return all_revenue.groupBy(PARTITION, "pickup_zone").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced_trips"),
    )


def fold_zone_revenue(months: DataFrame) -> DataFrame:
    """`revenue_by_zone` from the `monthly_zone_revenue` of all months."""
    mean = F.sum("revenue") / F.nullif(F.sum("priced_trips"), F.lit(0))
    return months.groupBy("pickup_zone").agg(
        F.sum("trips").alias("trip_count"),
        round_half_away(F.sum("revenue"), 2).alias("total_revenue"),
        round_half_away(mean, 2).alias("avg_fare"),
    )


def revenue_by_zone(all_revenue: DataFrame) -> DataFrame:
    return all_revenue.groupBy("pickup_zone").agg(
        F.count(F.lit(1)).alias("trip_count"),
        round_half_away(F.sum("total_amount"), 2).alias("total_revenue"),
        round_half_away(F.avg("total_amount"), 2).alias("avg_fare"),
    )


def zones_with_totals(polygons: DataFrame, totals: DataFrame) -> DataFrame:
    """Every polygon with its zone's revenue, zero where there is none.

    The match is by zone name, so polygons sharing a name each show the whole sum.
    """
    joined = polygons.join(totals, polygons["zone"] == totals["pickup_zone"], "left")
    zeros = {
        name: F.coalesce(F.col(name), F.lit(0)) for name in ("trip_count", "total_revenue", "avg_fare")
    }
    return conform(joined.withColumns(zeros), FINAL["zones_geo"])


def zones_geo(polygons: DataFrame, all_revenue: DataFrame) -> DataFrame:
    return zones_with_totals(polygons, revenue_by_zone(all_revenue))
