"""Casts, code names and scalar functions over all derived trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from gallery import fixture
from gallery.common import KEYS
from gallery.registry import query
from gallery.sql import instant, later, minutes, near, rain_band
from tripmart.functions import casts, clock, codes, labels
from tripmart.functions.rounding import round_half_away
from tripmart.operators.quality import within_month
from tripmart.plans import dashboard, marts

# --- casts ----------------------------------------------------------------------------------


@query(
    "c01_int_cast",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity / 2 AS INT) AS half_up_down,
        CAST(-l_quantity / 4 AS INT) AS negative, CAST(l_partkey AS INT) AS whole FROM lineitem""",
)
def int_cast(spark, sf_dir):
    lines = fixture.table(spark, sf_dir, "lineitem").select(
        *KEYS, (F.col("l_quantity") / 2).alias("a"), (-F.col("l_quantity") / 4).alias("b"), "l_partkey"
    )
    return lines.select(
        *KEYS,
        casts.int_column(lines, "a").alias("half_up_down"),
        casts.int_column(lines, "b").alias("negative"),
        casts.int_column(lines, "l_partkey").alias("whole"),
    )


@query(
    "c02_typed_casts",
    """SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS as_double,
        CAST(l_partkey AS VARCHAR) AS as_text,
        CAST(strftime(pickup, '%Y-%m-%dT%H:%M') AS TIMESTAMP) AS as_time,
        CAST(pickup AS DATE) AS as_day FROM line_trips""",
)
def typed_casts(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir).withColumn(
        "written", F.date_format("pickup", "yyyy-MM-dd'T'HH:mm")
    )
    return trips.select(
        *KEYS,
        casts.to_double("l_linenumber").alias("as_double"),
        casts.to_text("l_partkey").alias("as_text"),
        casts.to_wall_clock("written").alias("as_time"),
        casts.to_day(F.col("pickup")).alias("as_day"),
    )


_ZONES = ("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough")


def _projection(service):
    def run(spark, sf_dir):
        return fixture.staged(spark, sf_dir, service).drop(*_ZONES)

    return run


_WITHOUT_ZONES = "SELECT * EXCLUDE (pickup_zone, pickup_borough, dropoff_zone, dropoff_borough) FROM "
query("c03_yellow_projection", _WITHOUT_ZONES + "stg_yellow")(_projection("yellow_taxi"))
query("c04_green_projection", _WITHOUT_ZONES + "stg_green")(_projection("green_taxi"))
query("c05_app_projection", _WITHOUT_ZONES + "stg_app")(_projection("app_rides"))
query("c06_high_volume_projection", _WITHOUT_ZONES + "stg_hv")(_projection("high_volume_fhv"))


@query(
    "c07_weather_projection",
    "SELECT * EXCLUDE (weather_description) FROM stg_weather",
)
def weather_projection(spark, sf_dir):
    return fixture.staged_weather(spark, sf_dir).drop("weather_description")


@query("c08_zone_lookup", "SELECT * FROM zone_lookup")
def zone_lookup(spark, sf_dir):
    return fixture.zone_lookup(spark, sf_dir)


# --- code names -----------------------------------------------------------------------------


def _named(name, formula, sql_code, names, sql_names):
    """Every trip's code and its name."""
    sql = f"""SELECT l_orderkey, l_linenumber, c.id AS code, label
        FROM (SELECT l_orderkey, l_linenumber, {sql_code} AS id FROM line_trips) c
        LEFT JOIN {sql_names} n ON n.code = c.id"""

    @query(name, sql)
    def run(spark, sf_dir):
        trips = fixture.line_trips(spark, sf_dir).select(*KEYS, F.expr(formula).alias("code"))
        return trips.withColumn("label", codes.translate("code", names))


_named("c09_vendor", "1 + l_suppkey % 8", "1 + l_suppkey % 8", codes.VENDORS, "vendor_names")
_named(
    "c10_rate_code",
    "if(l_partkey % 8 = 7, 99, l_partkey % 8)",
    "CASE WHEN l_partkey % 8 = 7 THEN 99 ELSE l_partkey % 8 END",
    codes.RATE_CODES,
    "rate_names",
)
_named("c11_payment_type", "l_orderkey % 8", "l_orderkey % 8", codes.PAYMENT_TYPES, "payment_names")
_named("c12_trip_type", "1 + l_linenumber % 3", "1 + l_linenumber % 3", codes.TRIP_TYPES, "trip_type_names")
_named("c13_company", "licence", "licence", codes.COMPANIES, "company_names")
_named(
    "c14_weather_code",
    "element_at(array(%s), cast(l_orderkey %% 25 as int) + 1)" % fixture.WEATHER_CODES_USED,
    "[%s][l_orderkey %% 25 + 1]" % fixture.WEATHER_CODES_USED,
    codes.WEATHER_CODES,
    "weather_names",
)
_named(
    "c15_service_label",
    "case digit when '1' then 'yellow_taxi' when '2' then 'green_taxi' when '3' then 'app_rides' "
    "when '4' then 'high_volume_fhv' else 'other' end",
    "CASE digit WHEN '1' THEN 'yellow_taxi' WHEN '2' THEN 'green_taxi' WHEN '3' THEN 'app_rides' "
    "WHEN '4' THEN 'high_volume_fhv' ELSE 'other' END",
    codes.SERVICE_LABELS,
    "service_names",
)


@query(
    "c16_service_tag",
    """SELECT taxi_type, count(*) AS trips, count(fare_amount) AS fares,
        count(trip_distance_miles) AS distances, count(passenger_count) AS passenger_counts
        FROM trips GROUP BY taxi_type""",
)
def service_tag(spark, sf_dir):
    return (
        fixture.trips(spark, sf_dir)
        .groupBy("taxi_type")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count("fare_amount").alias("fares"),
            F.count("trip_distance_miles").alias("distances"),
            F.count("passenger_count").alias("passenger_counts"),
        )
    )


@query(
    "c17_fare_with_tip",
    """SELECT pickup_datetime, base_passenger_fare, tip_amount,
        base_passenger_fare + coalesce(tip_amount, 0) AS paid FROM stg_hv""",
)
def fare_with_tip(spark, sf_dir):
    return fixture.staged(spark, sf_dir, "high_volume_fhv").select(
        "pickup_datetime", "base_passenger_fare", "tip_amount", marts.fare_with_tip().alias("paid")
    )


# --- time -----------------------------------------------------------------------------------


@query(
    "f01_near_dst",
    f"""SELECT CAST(pickup AS DATE) AS day, count(*) AS trips, bool_and({near("pickup")}) AS near
        FROM line_trips GROUP BY 1""",
)
def near_dst(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.groupBy(F.col("pickup").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("trips"), F.bool_and(clock.near_switch(F.col("pickup"))).alias("near")
    )


# Parts of a second, so that boundaries and whole seconds differ
_START = "pickup + to_milliseconds(l_partkey % 1000)"
_END = "dropoff + to_milliseconds(l_suppkey * 37 % 1000)"


@query(
    "f02_second_boundaries",
    f"""SELECT l_orderkey, l_linenumber, date_diff('second', {_START}, {_END}) AS seconds
        FROM line_trips""",
)
def second_boundaries(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    start = F.expr("pickup + make_dt_interval(0, 0, 0, cast(l_partkey % 1000 / 1000 as decimal(8, 3)))")
    end = F.expr(
        "dropoff + make_dt_interval(0, 0, 0, cast(l_suppkey * 37 % 1000 / 1000 as decimal(8, 3)))"
    )
    return trips.select(*KEYS, clock.seconds_between(start, end).alias("seconds"))


@query(
    "f03_ny_instant",
    f"""SELECT l_orderkey, l_linenumber, pickup,
        CAST({instant("pickup")} AT TIME ZONE 'UTC' AS TIMESTAMP) AS in_utc FROM line_trips""",
)
def ny_instant(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(*KEYS, "pickup", clock.ny_instant(F.col("pickup")).alias("in_utc"))


@query(
    "f04_is_after",
    f"SELECT l_orderkey, l_linenumber, {later('dropoff', 'pickup')} AS in_order FROM line_trips",
)
def is_after(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(*KEYS, clock.is_after(F.col("dropoff"), F.col("pickup")).alias("in_order"))


@query(
    "f05_elapsed_minutes",
    f"SELECT l_orderkey, l_linenumber, {minutes('pickup', 'dropoff')} AS minutes FROM line_trips",
)
def elapsed_minutes(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(
        *KEYS, clock.elapsed_minutes(F.col("pickup"), F.col("dropoff")).alias("minutes")
    )


@query(
    "f06_day_of_week",
    """SELECT l_orderkey, l_linenumber, CAST(dayofweek(pickup) AS INT) AS sunday_is_0,
        CAST(isodow(pickup) AS INT) AS monday_is_1 FROM line_trips""",
)
def day_of_week(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(
        *KEYS,
        clock.sunday_first(F.col("pickup")).alias("sunday_is_0"),
        clock.monday_first(F.col("pickup")).alias("monday_is_1"),
    )


@query(
    "f07_hour_and_day",
    """SELECT l_orderkey, l_linenumber, date_trunc('hour', dropoff) AS hour_start,
        CAST(hour(dropoff) AS INT) AS hour_number, CAST(dropoff AS DATE) AS day FROM line_trips""",
)
def hour_and_day(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(
        *KEYS,
        clock.hour_start(F.col("dropoff")).alias("hour_start"),
        F.hour("dropoff").alias("hour_number"),
        F.col("dropoff").cast("date").alias("day"),
    )


@query(
    "f08_next_month",
    """SELECT l_orderkey, l_linenumber, pickup + INTERVAL 1 MONTH AS month_later,
        pickup >= CAST(partition_date AS TIMESTAMP)
        AND pickup < CAST(partition_date AS TIMESTAMP) + INTERVAL 1 MONTH AS in_month
        FROM line_trips""",
)
def next_month(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir).withColumn("pickup_datetime", F.col("pickup"))
    return trips.select(
        *KEYS,
        (F.col("pickup") + F.expr("INTERVAL 1 MONTH")).alias("month_later"),
        within_month().alias("in_month"),
    )


# --- numbers and labels ---------------------------------------------------------------------


@query(
    "f09_round",
    """SELECT l_orderkey, l_linenumber, round(l_partkey / 8, 2) AS eighths,
        round(-l_partkey / 200, 2) AS negative, round(l_quantity * l_discount / 4, 1) AS tenths,
        round(l_extendedprice / 2) AS whole FROM lineitem""",
)
def half_away(spark, sf_dir):
    lines = fixture.table(spark, sf_dir, "lineitem")
    return lines.select(
        *KEYS,
        round_half_away(F.col("l_partkey") / 8, 2).alias("eighths"),
        round_half_away(-F.col("l_partkey") / 200, 2).alias("negative"),
        round_half_away(F.col("l_quantity") * F.col("l_discount") / 4, 1).alias("tenths"),
        round_half_away(F.col("l_extendedprice") / 2).alias("whole"),
    )


@query(
    "f10_coalesce_nullif",
    """SELECT l_orderkey, l_linenumber, coalesce(tip, 0) AS tip_or_zero,
        fare / nullif(distance, 0) AS per_mile FROM line_trips""",
)
def coalesce_nullif(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(
        *KEYS,
        F.coalesce("tip", F.lit(0.0)).alias("tip_or_zero"),
        dashboard.ratio(F.col("fare"), F.col("distance")).alias("per_mile"),
    )


@query(
    "f11_hour_label",
    """SELECT l_orderkey, l_linenumber, lpad(CAST(hour(pickup) AS VARCHAR), 2, '0') || 'h'
        AS hour_label FROM line_trips""",
)
def hour_label(spark, sf_dir):
    trips = fixture.line_trips(spark, sf_dir)
    return trips.select(*KEYS, labels.hour_label(F.col("pickup")).alias("hour_label"))


@query(
    "f12_calculated_columns",
    """SELECT pickup_datetime, taxi_type, d.label AS weekday_label, d.numbered AS weekday,
        s.label AS taxi_type_label, lpad(CAST(hour(pickup_datetime) AS VARCHAR), 2, '0') || 'h'
        AS hour_label, CAST(isodow(pickup_datetime) AS INT) AS day_of_week,
        CAST(hour(pickup_datetime) AS INT) AS hour_of_day
        FROM trips JOIN day_names d ON d.code = isodow(pickup_datetime)
        JOIN service_names s ON s.code = taxi_type""",
)
def calculated_columns(spark, sf_dir):
    trips = dashboard.dataset("trips", {"trips": fixture.trips(spark, sf_dir)})
    return trips.select("pickup_datetime", "taxi_type", *dashboard.trip_columns())


@query(
    "f13_day_type",
    """SELECT CAST(pickup AS DATE) AS day, count(*) AS trips,
        CASE WHEN isodow(any_value(pickup)) > 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type
        FROM line_trips GROUP BY 1""",
)
def day_type(spark, sf_dir):
    days = fixture.line_trips(spark, sf_dir).groupBy(F.col("pickup").cast("date").alias("day"))
    counted = days.agg(F.count(F.lit(1)).alias("trips"))
    return counted.withColumn("day_type", labels.day_type(F.col("day")))


_MM = "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity / 2.5::DOUBLE END"


@query(
    "f14_rain_band",
    f"""SELECT l_orderkey, l_linenumber, mm, {rain_band("mm")} AS band
        FROM (SELECT l_orderkey, l_linenumber, {_MM} AS mm FROM lineitem)""",
)
def rain_bands(spark, sf_dir):
    lines = fixture.table(spark, sf_dir, "lineitem").select(
        *KEYS, F.expr("if(l_linenumber = 6, null, l_quantity / 2.5D)").alias("mm")
    )
    return lines.withColumn("band", labels.rain_band(F.col("mm")))
