"""Whole tables and dashboard charts."""

from __future__ import annotations

from gallery import fixture
from gallery.common import rounded
from gallery.registry import query
from tripmart.plans import dashboard

# --- marts and staging ----------------------------------------------------------------------

_SUMS = ("revenue", "distance_miles", "duration_minutes_with_distance")


@query("m01_trips", "SELECT * FROM trips")
def trips(spark, sf_dir):
    return fixture.trips(spark, sf_dir)


@query("m02_revenue", "SELECT * FROM revenue")
def revenue(spark, sf_dir):
    return fixture.revenue(spark, sf_dir)


@query("m03_weather_impact", "SELECT * FROM weather_impact")
def weather_impact(spark, sf_dir):
    return fixture.weather_impact(spark, sf_dir)


@query(
    "m04_trips_hourly",
    """SELECT pickup_hour, taxi_type, pickup_borough, pickup_zone, trips,
        round(revenue, 6) AS revenue, fare_trips, round(distance_miles, 6) AS distance_miles,
        round(duration_minutes_with_distance, 6) AS duration_minutes_with_distance,
        partition_date FROM trips_hourly""",
)
def trips_hourly(spark, sf_dir):
    return rounded(fixture.trips_hourly(spark, sf_dir), *_SUMS)


@query("m05_weather_daily", "SELECT * FROM weather_daily")
def weather_daily(spark, sf_dir):
    return fixture.weather_daily(spark, sf_dir)


@query("m06_zones_geo", "SELECT * FROM zones_geo")
def zones_geo(spark, sf_dir):
    return fixture.zones_geo(spark, sf_dir)


def _staged(service):
    return lambda spark, sf_dir: fixture.staged(spark, sf_dir, service)


query("m07_staged_yellow", "SELECT * FROM stg_yellow")(_staged("yellow_taxi"))
query("m07_staged_green", "SELECT * FROM stg_green")(_staged("green_taxi"))
query("m07_staged_app_rides", "SELECT * FROM stg_app")(_staged("app_rides"))
query("m07_staged_high_volume", "SELECT * FROM stg_hv")(_staged("high_volume_fhv"))


@query("m08_staged_weather", "SELECT * FROM stg_weather")
def staged_weather(spark, sf_dir):
    return fixture.staged_weather(spark, sf_dir)


@query("m08_reference_staging", "SELECT * FROM zone_lookup")
def reference_staging(spark, sf_dir):
    return fixture.zone_lookup(spark, sf_dir)


# --- charts ---------------------------------------------------------------------------------


def _hourly(spark, sf_dir):
    return {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}


@query("q01_total_trips", "SELECT sum(trips)::BIGINT AS trips FROM trips_hourly")
def total_trips(spark, sf_dir):
    return dashboard.chart("total_trips", _hourly(spark, sf_dir))


@query("q02_revenue", "SELECT round(sum(revenue), 6) AS revenue FROM trips_hourly")
def total_revenue(spark, sf_dir):
    return rounded(dashboard.chart("revenue", _hourly(spark, sf_dir)), "revenue")


@query(
    "q03_average_fare",
    "SELECT round(sum(revenue) / nullif(sum(fare_trips), 0), 6) AS avg_fare FROM trips_hourly",
)
def average_fare(spark, sf_dir):
    return rounded(dashboard.chart("average_fare", _hourly(spark, sf_dir)), "avg_fare")


@query(
    "q04_revenue_per_mile",
    """SELECT round(sum(revenue) / nullif(sum(distance_miles), 0), 6) AS revenue_per_mile
        FROM trips_hourly""",
)
def revenue_per_mile(spark, sf_dir):
    chart = dashboard.chart("revenue_per_mile", _hourly(spark, sf_dir))
    return rounded(chart, "revenue_per_mile")


@query(
    "q05_speed_by_hour",
    """SELECT lpad(CAST(hour(pickup_hour) AS VARCHAR), 2, '0') || 'h' AS hour_label,
        round(sum(distance_miles) / nullif(sum(duration_minutes_with_distance) / 60, 0), 6)
            AS avg_speed_mph
        FROM trips_hourly
        WHERE pickup_hour >= TIMESTAMP '2025-01-01' AND pickup_hour < TIMESTAMP '2025-08-01'
        GROUP BY 1 ORDER BY 1""",
)
def speed_by_hour(spark, sf_dir):
    return rounded(dashboard.chart("speed_by_hour", _hourly(spark, sf_dir)), "avg_speed_mph")


@query(
    "q06_hour_by_weekday",
    """SELECT lpad(CAST(hour(pickup_hour) AS VARCHAR), 2, '0') || 'h' AS hour_label,
        d.label AS weekday_label, sum(trips)::BIGINT AS trips
        FROM trips_hourly JOIN day_names d ON d.code = isodow(pickup_hour)
        GROUP BY ALL ORDER BY ALL""",
)
def hour_by_weekday(spark, sf_dir):
    return dashboard.chart("hour_by_weekday", _hourly(spark, sf_dir))


@query(
    "q07_top_zones",
    """SELECT pickup_zone, round(sum(revenue), 6) AS revenue FROM trips_hourly
        GROUP BY pickup_zone ORDER BY sum(revenue) DESC, pickup_zone LIMIT 10""",
)
def top_zones(spark, sf_dir):
    return rounded(dashboard.chart("top_zones", _hourly(spark, sf_dir)), "revenue")


@query(
    "q08_service_share",
    """SELECT 'All trips' AS bar, label AS taxi_type_label, sum(trips)::BIGINT AS trips,
        round(sum(trips) / sum(sum(trips)) OVER (), 6) AS share
        FROM trips_hourly JOIN service_names ON code = taxi_type GROUP BY label""",
)
def service_share(spark, sf_dir):
    return rounded(dashboard.chart("service_share", _hourly(spark, sf_dir)), "share")


@query(
    "q09_zone_map",
    """SELECT geometry_json, zone, borough, round(sum(total_revenue), 6) AS total_revenue,
        CASE WHEN sum(total_revenue) < 0 OR sum(total_revenue) > 470000000 THEN NULL
             WHEN sum(total_revenue) < 6000000 THEN 1 WHEN sum(total_revenue) < 13000000 THEN 2
             WHEN sum(total_revenue) < 22000000 THEN 3 WHEN sum(total_revenue) < 45000000 THEN 4
             WHEN sum(total_revenue) < 100000000 THEN 5 ELSE 6 END AS bucket
        FROM zones_geo WHERE geometry_json IS NOT NULL GROUP BY geometry_json, zone, borough""",
)
def zone_map(spark, sf_dir):
    tables = {"zones_geo": fixture.zones_geo(spark, sf_dir)}
    return rounded(dashboard.chart("zone_map", tables), "total_revenue")


@query(
    "q10_rain_effect",
    """SELECT rain_intensity, round(avg(vs_dry_same_weekday), 6) AS trips_vs_dry_day
        FROM rain_days WHERE total_precipitation_mm >= 1 GROUP BY rain_intensity""",
)
def rain_effect(spark, sf_dir):
    tables = {"weather_daily": fixture.weather_daily(spark, sf_dir)}
    return rounded(dashboard.chart("rain_effect", tables), "trips_vs_dry_day")


@query(
    "q11_service_values",
    """SELECT DISTINCT label AS taxi_type_label FROM trips JOIN service_names ON code = taxi_type""",
)
def service_values(spark, sf_dir):
    return dashboard.service_values({"trips": fixture.trips(spark, sf_dir)})


@query("q12_borough_values", "SELECT DISTINCT pickup_borough FROM revenue")
def borough_values(spark, sf_dir):
    return dashboard.borough_values({"revenue": fixture.revenue(spark, sf_dir)})


@query(
    "q13_rain_daily",
    """SELECT date, day_type, total_precipitation_mm, trips, rain_intensity,
        round(vs_dry_same_weekday, 6) AS vs_dry_same_weekday FROM rain_days""",
)
def rain_daily(spark, sf_dir):
    days = dashboard.rain_intensity_daily(fixture.weather_daily(spark, sf_dir))
    return rounded(days, "vs_dry_same_weekday")
