"""Filters, joins, aggregates, windows, orderings and unions over all derived trips."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from gallery import fixture, stored
from gallery.common import rounded, to_six
from gallery.registry import query
from gallery.sql import clean, later
from tripmart.operators import checks, quality
from tripmart.operators.dimensions import broadcast_if_small, with_zones
from tripmart.plans import dashboard, marts, suites

TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def _raw(service):
    return lambda spark, sf_dir: fixture.raw_trips(spark, sf_dir, service)


def _kept(name, sql, service, columns, condition):
    """Raw records that pass one staging filter."""

    @query(name, sql)
    def run(spark, sf_dir):
        return fixture.raw_trips(spark, sf_dir, service).where(condition()).select(*columns)


_YELLOW = ("VendorID", *TIMES, "PULocationID", "trip_distance", "fare_amount", "passenger_count")
_YELLOW_SQL = f"SELECT {', '.join(_YELLOW)} FROM raw_yellow WHERE "

# Fixed rules: which records count as trips
_kept(
    "p01_times_present",
    _YELLOW_SQL + f"{TIMES[0]} IS NOT NULL AND {TIMES[1]} IS NOT NULL",
    "yellow_taxi",
    _YELLOW,
    lambda: quality.present(*TIMES),
)
_kept(
    "p02_dropoff_after_pickup",
    _YELLOW_SQL + later(TIMES[1], TIMES[0]),
    "yellow_taxi",
    _YELLOW,
    lambda: quality.times_in_order(*TIMES),
)
_kept(
    "p03_zones_present",
    _YELLOW_SQL + "PULocationID IS NOT NULL AND DOLocationID IS NOT NULL",
    "yellow_taxi",
    _YELLOW,
    lambda: quality.present("PULocationID", "DOLocationID"),
)
_kept(
    "p04_positive_amounts",
    _YELLOW_SQL + "trip_distance > 0 AND fare_amount > 0 AND total_amount > 0",
    "yellow_taxi",
    _YELLOW,
    lambda: quality.positive("trip_distance", "fare_amount", "total_amount"),
)
_kept(
    "p05_passengers",
    _YELLOW_SQL + "passenger_count IS NULL OR passenger_count > 0",
    "yellow_taxi",
    _YELLOW,
    lambda: quality.unknown_or_positive(F.col("passenger_count")),
)
_kept(
    "p06_base_present",
    "SELECT dispatching_base_num, pickup_datetime FROM raw_app WHERE dispatching_base_num IS NOT NULL",
    "app_rides",
    ("dispatching_base_num", "pickup_datetime"),
    lambda: quality.present("dispatching_base_num"),
)


@query(
    "p07_quality_rules",
    """SELECT count(*) AS staged,
        count_if(pickup_datetime >= partition_date
            AND pickup_datetime < CAST(partition_date AS TIMESTAMP) + INTERVAL 1 MONTH) AS in_month,
        count_if(trip_duration_minutes BETWEEN 2 AND 120) AS short_enough,
        count_if(pickup_datetime >= partition_date
            AND pickup_datetime < CAST(partition_date AS TIMESTAMP) + INTERVAL 1 MONTH
            AND trip_duration_minutes BETWEEN 2 AND 120
            AND trip_distance_miles > 0 AND trip_distance_miles <= 50
            AND total_amount > 0 AND total_amount <= 500) AS kept
        FROM stg_yellow""",
)
def quality_rules(spark, sf_dir):
    """The rules with other limits than the default ones."""
    rules = quality.clean_trip(
        "total_amount", True, min_minutes=2, max_minutes=120, max_miles=50, max_fare=500
    )
    return fixture.staged(spark, sf_dir, "yellow_taxi").agg(
        F.count(F.lit(1)).alias("staged"),
        F.count_if(quality.within_month()).alias("in_month"),
        F.count_if(F.col("trip_duration_minutes").between(2, 120)).alias("short_enough"),
        F.count_if(rules).alias("kept"),
    )


_NARROW = quality.Limits(min_minutes=2, max_minutes=120, max_miles=50, max_fare=500)
_NARROW_SQL = {"minutes": (2, 120), "miles": 50, "most": 500}


@query(
    "p07_build_with_limits",
    " UNION ALL ".join(
        f"SELECT '{service}' AS taxi_type, partition_date, count(*) AS trips, "
        f"max(trip_duration_minutes) AS longest, max({miles}) AS farthest "
        f"FROM ({clean(table, fare, miles != 'NULL::DOUBLE', **_NARROW_SQL)}) WHERE pickup_borough IS NOT NULL GROUP BY ALL"
        for service, table, fare, miles in (
            ("yellow_taxi", "stg_yellow", "total_amount", "trip_distance_miles"),
            ("green_taxi", "stg_green", "total_amount", "trip_distance_miles"),
            ("app_rides", "stg_app", None, "NULL::DOUBLE"),
            ("high_volume_fhv", "stg_hv", "base_passenger_fare", "trip_distance_miles"),
        )
    ),
)
def build_with_limits(spark, sf_dir):
    """The trips mart of a lake that sets its own limits, from stored staging."""
    lake = replace(stored.staged_lake(spark, sf_dir), limits=_NARROW)
    return lake.plan("trips").groupBy("taxi_type", "partition_date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.max("trip_duration_minutes").alias("longest"),
        F.max("trip_distance_miles").alias("farthest"),
    )


@query(
    "p07_tests_with_limits",
    """SELECT 'trip_duration_minutes' AS tested,
            (SELECT count(*) FROM trips WHERE trip_duration_minutes NOT BETWEEN 2 AND 120) AS usual_mart, 0 AS own_mart
        UNION ALL SELECT 'trip_distance_miles',
            (SELECT count(*) FROM trips WHERE trip_distance_miles > 50), 0""",
)
def tests_with_limits(spark, sf_dir):
    """Tests that follow a build's limits: failures in the mart of the usual limits, and in its own."""
    lake = stored.staged_lake(spark, sf_dir)
    suite = [c for c in suites.final(_NARROW)["trips"] if c.column in ("trip_duration_minutes", "trip_distance_miles")]
    found = [
        checks.run_checks(one.plan("trips"), suite).select(
            F.regexp_replace("check", "accepted_range_", "").alias("tested"),
            *[(F.col("failures") if name == own else F.lit(0)).cast("bigint").alias(name) for name in ("usual_mart", "own_mart")],
        )
        for own, one in (("usual_mart", lake), ("own_mart", replace(lake, limits=_NARROW)))
    ]
    return marts.stack(found).groupBy("tested").agg(
        F.sum("usual_mart").alias("usual_mart"), F.sum("own_mart").alias("own_mart")
    )


_CLEAN_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS taxi_type, partition_date, pickup_datetime, trip_duration_minutes FROM {t}"
    for s, t in (
        ("yellow_taxi", "clean_yellow"),
        ("green_taxi", "clean_green"),
        ("app_rides", "clean_app"),
        ("high_volume_fhv", "clean_hv"),
    )
)


@query("p08_clean_trips", _CLEAN_SQL)
def clean_trips(spark, sf_dir):
    return marts.stack(
        [
            marts.clean(rows, service).select(
                F.lit(service).alias("taxi_type"),
                "partition_date",
                "pickup_datetime",
                "trip_duration_minutes",
            )
            for service, rows in fixture.all_staged(spark, sf_dir).items()
        ]
    )


@query(
    "p09_known_pickup",
    """SELECT (SELECT count(*) FROM trips) AS trips, (SELECT count(*) FROM revenue) AS revenue,
        (SELECT count(*) FROM weather_impact) AS weather_impact""",
)
def known_pickup(spark, sf_dir):
    """Trips need a borough, revenue a zone, weather neither."""
    staged = fixture.all_staged(spark, sf_dir)
    parts = marts.stack(
        [
            marts.clean(rows, service).select(
                F.col("pickup_borough").isNotNull().alias("has_borough"),
                (
                    F.col("pickup_zone").isNotNull() & F.lit(service != "app_rides")
                ).alias("has_priced_zone"),
            )
            for service, rows in staged.items()
        ]
    )
    return parts.agg(
        F.count_if("has_borough").alias("trips"),
        F.count_if("has_priced_zone").alias("revenue"),
        F.count(F.lit(1)).alias("weather_impact"),
    )


_PERIOD = (datetime(2025, 3, 1), datetime(2026, 1, 15, 12))


@query(
    "p10_time_range",
    """SELECT pickup_hour, taxi_type, pickup_zone, trips FROM trips_hourly
        WHERE pickup_hour >= TIMESTAMP '2025-03-01' AND pickup_hour < TIMESTAMP '2026-01-15 12:00'""",
)
def time_range(spark, sf_dir):
    hourly = fixture.trips_hourly(spark, sf_dir)
    return dashboard.in_period(hourly, "pickup_hour", _PERIOD).select(
        "pickup_hour", "taxi_type", "pickup_zone", "trips"
    )


_FILTERS = dashboard.Filters(
    period=_PERIOD, services=("Yellow", "Uber/Lyft"), boroughs=("ASIA", "EUROPE")
)


@query(
    "p11_dashboard_filters",
    """SELECT label AS taxi_type_label, pickup_borough, sum(trips)::BIGINT AS trips
        FROM trips_hourly JOIN service_names ON code = taxi_type
        WHERE pickup_hour >= TIMESTAMP '2025-03-01' AND pickup_hour < TIMESTAMP '2026-01-15 12:00'
            AND label IN ('Yellow', 'Uber/Lyft') AND pickup_borough IN ('ASIA', 'EUROPE')
        GROUP BY ALL""",
)
def dashboard_filters(spark, sf_dir):
    tables = {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}
    hourly = dashboard.apply_filters(
        dashboard.dataset("trips_hourly", tables), "pickup_hour", _FILTERS
    )
    return hourly.groupBy("taxi_type_label", "pickup_borough").agg(F.sum("trips").alias("trips"))


@query(
    "p12_cross_filter",
    """SELECT pickup_zone, round(sum(revenue), 6) AS revenue FROM trips_hourly
        JOIN service_names ON code = taxi_type
        WHERE label = 'Green' AND lpad(CAST(hour(pickup_hour) AS VARCHAR), 2, '0') || 'h' = '08h'
        GROUP BY pickup_zone ORDER BY sum(revenue) DESC, pickup_zone LIMIT 10""",
)
def cross_filter(spark, sf_dir):
    """A service and an hour clicked elsewhere filter the zones; a clicked zone does not."""
    tables = {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}
    clicks = {"service_share": "Green", "speed_by_hour": "08h", "top_zones": "FRANCE"}
    return rounded(dashboard.cross_filtered("top_zones", tables, clicks), "revenue")


# --- joins ----------------------------------------------------------------------------------


@query(
    "j01_zone_twice",
    """SELECT l_orderkey, l_linenumber, p.zone AS pickup_zone, p.borough AS pickup_borough,
        d.zone AS dropoff_zone, d.borough AS dropoff_borough
        FROM line_trips LEFT JOIN zone_lookup p ON p.location_id = pickup_zone_id
        LEFT JOIN zone_lookup d ON d.location_id = dropoff_zone_id""",
)
def zone_twice(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    lookup = broadcast_if_small(fixture.zone_lookup(spark, sf_dir))
    zoned = with_zones(trips, lookup, "pickup_zone_id", "dropoff_zone_id")
    return zoned.select(
        "l_orderkey",
        "l_linenumber",
        "pickup_zone",
        "pickup_borough",
        "dropoff_zone",
        "dropoff_borough",
    )


@query(
    "j02_daily_weather",
    """SELECT f.date, count(*) AS trips, count(w.date) AS trips_with_weather,
        max(weather_description) AS weather_description,
        max(total_precipitation_mm) AS total_precipitation_mm
        FROM dated_fares f LEFT JOIN day_weather w ON f.date = w.date GROUP BY f.date""",
)
def daily_weather(spark, sf_dir):
    impact = fixture.weather_impact(spark, sf_dir)
    return impact.groupBy("date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("total_precipitation_mm").alias("trips_with_weather"),
        F.max("weather_description").alias("weather_description"),
        F.max("total_precipitation_mm").alias("total_precipitation_mm"),
    )


@query(
    "j03_zone_revenue",
    """SELECT location_id, p.zone, coalesce(trip_count, 0) AS trip_count,
        coalesce(total_revenue, 0) AS total_revenue, coalesce(avg_fare, 0) AS avg_fare
        FROM polygons p LEFT JOIN zone_revenue r ON r.pickup_zone = p.zone""",
)
def zone_revenue(spark, sf_dir):
    return fixture.zones_geo(spark, sf_dir).drop("borough", "geometry_json")


@query(
    "j04_missing_keys",
    """SELECT c_nationkey, count(*) AS n_records FROM line_trips
        WHERE c_nationkey NOT IN (SELECT location_id FROM zone_lookup) GROUP BY c_nationkey""",
)
def missing_keys(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return checks.missing_in_lookup(
        trips, "c_nationkey", fixture.zone_lookup(spark, sf_dir), "location_id"
    )


@query(
    "j05_scalar_totals",
    """SELECT mart, mart_trips, (SELECT count(*) FROM trips) AS trips FROM (
        SELECT 'trips_hourly' AS mart, sum(trips)::BIGINT AS mart_trips FROM trips_hourly
        UNION ALL SELECT 'weather_daily', sum(trips)::BIGINT FROM weather_daily)
        WHERE mart_trips <> (SELECT count(*) FROM trips)""",
)
def scalar_totals(spark, sf_dir):
    """Here some trips have no borough, so the weather mart counts more of them."""
    return checks.unreconciled(
        fixture.trips(spark, sf_dir),
        trips_hourly=fixture.trips_hourly(spark, sf_dir),
        weather_daily=fixture.weather_daily(spark, sf_dir),
    )


# --- aggregates -----------------------------------------------------------------------------

_SUMS = ("revenue", "distance_miles", "duration_minutes_with_distance")


@query(
    "a01_hourly",
    """SELECT * REPLACE (round(revenue, 6) AS revenue, round(distance_miles, 6) AS distance_miles,
        round(duration_minutes_with_distance, 6) AS duration_minutes_with_distance)
        FROM trips_hourly""",
)
def hourly(spark, sf_dir):
    return rounded(fixture.trips_hourly(spark, sf_dir), *_SUMS)


@query("a02_daily_weather", "SELECT * FROM day_weather")
def weather_by_day(spark, sf_dir):
    return marts.daily_weather(fixture.staged_weather(spark, sf_dir))


@query("a03_trips_by_day", "SELECT * FROM weather_daily")
def trips_by_day(spark, sf_dir):
    return fixture.weather_daily(spark, sf_dir)


@query("a04_revenue_by_zone", "SELECT * FROM zone_revenue")
def revenue_by_zone(spark, sf_dir):
    return marts.revenue_by_zone(fixture.revenue(spark, sf_dir))


@query(
    "a05_rows_per_month",
    "SELECT partition_date AS partition_value, count(*) AS row_count FROM raw_hv GROUP BY 1",
)
def rows_per_month(spark, sf_dir):
    return checks.rows_per_partition(_raw("high_volume_fhv")(spark, sf_dir), "partition_date")


_REPEATED = """SELECT l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_discount FROM lineitem"""


@query(
    "a06_duplicate_rows",
    f"""SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({_REPEATED})))
        AS duplicate_rows FROM ({_REPEATED})""",
)
def duplicate_rows(spark, sf_dir):
    lines = fixture.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount"
    )
    return checks.duplicate_rows(lines)


@query(
    "a07_hourly_metrics",
    """SELECT taxi_type, sum(trips)::BIGINT AS count, round(sum(revenue), 6) AS total_fare,
        round(sum(revenue) / nullif(sum(fare_trips), 0), 6) AS avg_fare,
        round(sum(revenue) / nullif(sum(distance_miles), 0), 6) AS revenue_per_mile,
        round(sum(distance_miles) / nullif(sum(duration_minutes_with_distance) / 60, 0), 6)
            AS avg_speed_mph
        FROM trips_hourly GROUP BY taxi_type""",
)
def hourly_metrics(spark, sf_dir):
    tables = {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}
    ratios = ("total_fare", "avg_fare", "revenue_per_mile", "avg_speed_mph")
    return rounded(dashboard.metric_table("trips_hourly", tables, ["taxi_type"]), *ratios)


@query(
    "a08_trip_metrics",
    """SELECT 'trips' AS dataset, taxi_type, count(*) AS rows, round(sum(fare_amount), 6) AS amount,
        round(avg(fare_amount), 6) AS avg_fare,
        round(sum(fare_amount) / nullif(sum(trip_distance_miles), 0), 6) AS revenue_per_mile
        FROM trips GROUP BY taxi_type
        UNION ALL SELECT 'revenue', taxi_type, count(*), round(sum(total_amount), 6),
        round(avg(fare_amount), 6), NULL FROM revenue GROUP BY taxi_type
        UNION ALL SELECT 'zones_geo', NULL, count(*), NULL, NULL, NULL FROM zones_geo
        UNION ALL SELECT 'rain_intensity_daily', NULL, count(*), NULL, NULL, NULL FROM rain_days""",
)
def trip_metrics(spark, sf_dir):
    tables = {
        "trips": fixture.trips(spark, sf_dir),
        "revenue": fixture.revenue(spark, sf_dir),
        "zones_geo": fixture.zones_geo(spark, sf_dir),
        "weather_daily": fixture.weather_daily(spark, sf_dir),
    }
    parts = []
    for name, amount, by in (
        ("trips", "total_fare", ["taxi_type"]),
        ("revenue", "total_revenue", ["taxi_type"]),
        ("zones_geo", None, []),
        ("rain_intensity_daily", None, []),
    ):
        table = dashboard.metric_table(name, tables, by)
        columns = table.columns

        def number(column):
            known = F.col(column) if column in columns else F.lit(None)
            return to_six(known.cast("double"))

        parts.append(
            table.select(
                F.lit(name).alias("dataset"),
                (F.col("taxi_type") if by else F.lit(None).cast("string")).alias("taxi_type"),
                F.col("count").alias("rows"),
                number(amount).alias("amount"),
                number("avg_fare").alias("avg_fare"),
                number("revenue_per_mile").alias("revenue_per_mile"),
            )
        )
    return marts.stack(parts)


# --- windows --------------------------------------------------------------------------------


@query(
    "n01_previous_average",
    """SELECT partition_date AS partition_value, count(*) AS row_count, round(avg(count(*)) OVER (
        ORDER BY partition_date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS previous_avg
        FROM raw_yellow GROUP BY partition_date""",
)
def previous_average(spark, sf_dir):
    counts = checks.rows_per_partition(_raw("yellow_taxi")(spark, sf_dir), "partition_date")
    return rounded(checks.with_previous_average(counts), "previous_avg")


@query(
    "n02_dry_baseline",
    """SELECT date, trips, round(trips / (vs_dry_same_weekday + 1), 6) AS usual_dry_trips
        FROM rain_days""",
)
def dry_baseline(spark, sf_dir):
    days = dashboard.rain_intensity_daily(fixture.weather_daily(spark, sf_dir))
    usual = F.col("trips") / (F.col("vs_dry_same_weekday") + 1)
    return days.select("date", "trips", to_six(usual).alias("usual_dry_trips"))


@query(
    "n03_share",
    """SELECT pickup_borough, taxi_type, sum(trips)::BIGINT AS trips,
        round(sum(trips) / sum(sum(trips)) OVER (PARTITION BY pickup_borough), 6) AS share
        FROM trips_hourly GROUP BY pickup_borough, taxi_type""",
)
def share(spark, sf_dir):
    grouped = (
        fixture.trips_hourly(spark, sf_dir)
        .groupBy("pickup_borough", "taxi_type")
        .agg(F.sum("trips").alias("trips"))
        .withColumn("bar", F.col("pickup_borough"))
    )
    bar = F.sum("trips").over(Window.partitionBy("bar"))
    shared = grouped.withColumn("share", dashboard.ratio(F.col("trips"), bar))
    return rounded(shared.drop("bar"), "share")


# --- order, limit, union --------------------------------------------------------------------


@query(
    "o01_top10",
    """SELECT pickup_zone, round(sum(revenue), 6) AS revenue FROM trips_hourly
        GROUP BY pickup_zone ORDER BY sum(revenue) DESC, pickup_zone LIMIT 10""",
)
def top10(spark, sf_dir):
    tables = {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}
    return rounded(dashboard.chart("top_zones", tables), "revenue")


@query(
    "o02_axis_order",
    """SELECT label AS axis_label, row_number() OVER (ORDER BY label) AS place FROM (
        SELECT DISTINCT lpad(CAST(hour(pickup_hour) AS VARCHAR), 2, '0') || 'h' AS label
        FROM trips_hourly)""",
)
def axis_order(spark, sf_dir):
    """The place each label gets on an axis sorted by text. The window sees the 24 labels."""
    tables = {"trips_hourly": fixture.trips_hourly(spark, sf_dir)}
    values = dashboard.filter_values("trips_hourly", "hour_label", tables)
    place = F.row_number().over(Window.orderBy("hour_label"))
    return values.select(F.col("hour_label").alias("axis_label"), place.cast("bigint").alias("place"))


@query(
    "o03_label_order",
    """SELECT d.label AS weekday_label, count(*) AS trips,
        row_number() OVER (ORDER BY d.label DESC) AS place
        FROM trips JOIN day_names d ON d.code = isodow(pickup_datetime) GROUP BY d.label""",
)
def label_order(spark, sf_dir):
    """Weekdays sorted as text stand in calendar order. The window sees the seven labels."""
    trips = dashboard.dataset("trips", {"trips": fixture.trips(spark, sf_dir)})
    counted = trips.groupBy("weekday_label").agg(F.count(F.lit(1)).alias("trips"))
    place = F.row_number().over(Window.orderBy(F.desc("weekday_label")))
    return counted.withColumn("place", place.cast("bigint"))


@query(
    "u01_union_services",
    """SELECT taxi_type, partition_date, count(*) AS trips FROM trips GROUP BY ALL""",
)
def union_services(spark, sf_dir):
    return (
        fixture.trips(spark, sf_dir)
        .groupBy("taxi_type", "partition_date")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query("u02_distinct_rows", f"SELECT DISTINCT * FROM ({_REPEATED})")
def distinct_rows(spark, sf_dir):
    return (
        fixture.table(spark, sf_dir, "lineitem")
        .select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount")
        .distinct()
    )
