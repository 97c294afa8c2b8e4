"""Trips, weather and zones derived from the driver's tables.

A line item is a trip: its order says when and for which service, its supplier and customer
where. Formulas (the same ones stand in `gallery.sql`):

- service: first character of the order priority; 1 yellow, 2 green, 3 app rides, 4/5 high volume
- pickup: order date + 28 years (same weekdays, and today's daylight-saving rules)
  + ((orderkey*37 + linenumber*11) % 1440) minutes
- drop-off: pickup + (quantity*330 - 300) seconds; a minute before pickup where partkey % 89 = 7;
  NULL where partkey % 97 = 13
- distance: (partkey % 1100) / 10
- fare: extendedprice / 100, negative (a refund) where partkey % 61 = 3; tip: fare * discount,
  NULL for return flag N; total: fare + tip
- passengers: linenumber % 5, NULL for line 6
- zones: nation of the supplier (NULL where partkey % 71 = 5) and of the customer
- month: the order's, or the next one for line 7 (misdated)
- codes: small remainders of the keys, each with at least one unlisted value

Weather: one row per hour of the events, a year later, which covers January 2025 only: most trip
months have none. Measures are multiples of 1/64 or 1/4, so that sums of doubles do not depend on
their order.

The `faultless` variant has the same rows with these faults mended, for flows that must pass the
raw tests: no NULL times, bases or zones, nation 24 moved to nation 0, no misdated months (the last
one, of a single day, joins the month before), listed licences and weather codes only, and weather
for the 31st, which repeats the day before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.common import once
from tripmart.operators.dimensions import broadcast_if_small
from tripmart.plans import marts, staging
from tripmart.session import tune
from tripmart.sources import schemas
from tripmart.sources.lake import conform
from tripmart.sources.polygons import zone_geometry

SERVICE_DIGITS = {
    "yellow_taxi": ("1",),
    "green_taxi": ("2",),
    "app_rides": ("3",),
    "high_volume_fhv": ("4", "5"),
}


# The driver's tables; declared, so that building a query opens no file
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )


# What the formulas of trips use
_LINE_COLUMNS = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax
    l_returnflag l_linestatus o_orderdate o_orderpriority s_nationkey c_nationkey""".split()


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined tables, written once per session for what reads the trips of several services.

    Joining them anew for each service would shuffle all line items each time. Here they are shuffled
    once: the few suppliers are broadcast, and orders meet their customers before the line items.
    What is typed, cleaned and written from them runs with the library's settings.
    """
    tune(spark)

    def write(location: str) -> None:
        lines = table(spark, sf_dir, "lineitem")
        suppliers = broadcast_if_small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
            orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        joined.select(*_LINE_COLUMNS).write.mode("overwrite").parquet(location)

    types = {part.split()[0]: part for columns in SCHEMAS.values() for part in columns.split(", ")}
    location = once(spark, sf_dir, "lines", write)
    return spark.read.schema(", ".join(types[c] for c in _LINE_COLUMNS)).parquet(location)


def _month(faultless: bool) -> str:
    month = "trunc(add_months(cast(o_orderdate as date), 28 * 12), 'month')"
    if faultless:
        return f"least({month}, date '2029-07-01')"
    return f"add_months({month}, if(l_linenumber = 7, 1, 0))"


def lines_by_month(lines: DataFrame, service: str, faultless: bool) -> DataFrame:
    """One service's joined lines, moved to tasks by the month of their trips.

    Lines are narrower than the records derived from them, so these are derived after the shuffle.
    """
    own = lines.where(F.expr("left(o_orderpriority, 1)").isin(*SERVICE_DIGITS[service]))
    return own.withColumn("line_month", F.expr(_month(faultless))).hint("rebalance", F.col("line_month"))


def line_trips(
    spark: SparkSession, sf_dir: str, faultless: bool = False, joined: DataFrame | None = None
) -> DataFrame:
    """All trips with the driver tables' columns and the derived ones."""
    if joined is None:
        joined = _joined_lines(spark, sf_dir)
    timed = joined.withColumns(
        {
            "digit": F.expr("left(o_orderpriority, 1)"),
            "pickup": F.expr(
                "o_orderdate + interval 28 years + make_dt_interval(0, 0, "
                "cast((l_orderkey * 37 + l_linenumber * 11) % 1440 as int))"
            ),
            "fare": F.expr("l_extendedprice / 100 * if(l_partkey % 61 = 3, -1, 1)"),
            "ride_seconds": F.expr("cast(l_quantity * 330 - 300 as int)"),
        }
    )
    arrival = "pickup + make_dt_interval(0, 0, 0, ride_seconds)"
    early = "l_partkey % 89 = 7 then pickup - interval 1 minute"
    if faultless:
        faults = {
            "dropoff": f"case when {early} else {arrival} end",
            "pickup_zone_id": "s_nationkey % 24",
            "dropoff_zone_id": "c_nationkey % 24",
            "base": "concat('B', lpad(cast(l_suppkey as string), 5, '0'))",
            "licence": "concat('HV000', cast(2 + l_suppkey % 4 as string))",
        }
    else:
        faults = {
            "dropoff": f"case when l_partkey % 97 = 13 then null when {early} else {arrival} end",
            "pickup_zone_id": "if(l_partkey % 71 = 5, null, s_nationkey)",
            "dropoff_zone_id": "c_nationkey",
            "base": (
                "if(l_suppkey % 50 = 11, null, "
                "concat('B', lpad(cast(l_suppkey as string), 5, '0')))"
            ),
            "licence": "concat('HV000', cast(2 + l_suppkey % 5 as string))",
        }
    derived = {
        "distance": "(l_partkey % 1100) / 10D",
        "tip": "if(l_returnflag = 'N', null, fare * l_discount)",
        "passengers": "if(l_linenumber = 6, null, l_linenumber % 5)",
        "partition_date": _month(faultless),
        **faults,
    }
    return timed.selectExpr("*", *[f"{f} as {n}" for n, f in derived.items()]).selectExpr(
        "*", "fare + coalesce(tip, 0D) as total"
    )


_TAXI = {
    "VendorID": "1 + l_suppkey % 8",
    "passenger_count": "passengers",
    "trip_distance": "distance",
    "RatecodeID": "if(l_partkey % 8 = 7, 99, l_partkey % 8)",
    "store_and_fwd_flag": "if(l_linestatus = 'F', 'Y', 'N')",
    "PULocationID": "pickup_zone_id",
    "DOLocationID": "dropoff_zone_id",
    "payment_type": "l_orderkey % 8",
    "fare_amount": "fare",
    "extra": "l_tax * 10",
    "mta_tax": "0.5D",
    "tip_amount": "tip",
    "tolls_amount": "(l_partkey % 7) * 1.0D",
    "improvement_surcharge": "1.0D",
    "total_amount": "total",
    "congestion_surcharge": "if(l_linenumber = 4, null, 2.5D)",
}
COLUMNS = {
    "yellow_taxi": {
        **_TAXI,
        "tpep_pickup_datetime": "pickup",
        "tpep_dropoff_datetime": "dropoff",
        "Airport_fee": "if(l_linenumber = 3, null, 1.75D)",
    },
    "green_taxi": {
        **_TAXI,
        "lpep_pickup_datetime": "pickup",
        "lpep_dropoff_datetime": "dropoff",
        "trip_type": "1 + l_linenumber % 3",
    },
    "app_rides": {
        "dispatching_base_num": "base",
        "pickup_datetime": "pickup",
        "dropOff_datetime": "dropoff",
        "PUlocationID": "pickup_zone_id",
        "DOlocationID": "dropoff_zone_id",
        "SR_Flag": "if(l_linenumber = 2, '1', null)",
        "Affiliated_base_number": "concat('B', lpad(cast(l_suppkey % 40 as string), 5, '0'))",
    },
    "high_volume_fhv": {
        "hvfhs_license_num": "licence",
        "dispatching_base_num": "concat('B', lpad(cast(l_suppkey as string), 5, '0'))",
        "originating_base_num": "if(l_linenumber = 5, null, concat('B', lpad(cast(l_suppkey as string), 5, '0')))",
        "request_datetime": "pickup - make_dt_interval(0, 0, l_linenumber)",
        "on_scene_datetime": "if(l_returnflag = 'R', null, pickup - interval 30 seconds)",
        "pickup_datetime": "pickup",
        "dropoff_datetime": "dropoff",
        "PULocationID": "pickup_zone_id",
        "DOLocationID": "dropoff_zone_id",
        "trip_miles": "distance",
        "trip_time": "ride_seconds",
        "base_passenger_fare": "fare",
        "tolls": "(l_partkey % 7) * 1.0D",
        "bcf": "fare * 0.03D",
        "sales_tax": "fare * l_tax",
        "congestion_surcharge": "if(l_linenumber = 4, null, 2.75D)",
        "airport_fee": "if(l_linenumber = 3, 2.5D, 0D)",
        "tips": "tip",
        "driver_pay": "fare * 0.75D",
        "shared_request_flag": "if(l_partkey % 3 = 0, 'Y', 'N')",
        "shared_match_flag": "if(l_partkey % 6 = 0, 'Y', 'N')",
        "access_a_ride_flag": "if(l_partkey % 4 = 0, 'Y', ' ')",
        "wav_request_flag": "if(l_partkey % 5 = 0, 'Y', 'N')",
        "wav_match_flag": "if(l_partkey % 10 = 0, 'Y', 'N')",
    },
}


def raw_trips(
    spark: SparkSession, sf_dir: str, service: str, faultless: bool = False, joined: DataFrame | None = None
) -> DataFrame:
    """One service's records with the published columns."""
    rows = line_trips(spark, sf_dir, faultless, joined).where(F.col("digit").isin(*SERVICE_DIGITS[service]))
    columns = [f"{formula} as `{name}`" for name, formula in COLUMNS[service].items()]
    return conform(
        rows.selectExpr(*columns, "partition_date"), f"{schemas.RAW[service]}, partition_date date"
    )


def raw_weather(spark: SparkSession, sf_dir: str, faultless: bool = False) -> DataFrame:
    n_codes = 24 if faultless else 25
    events = table(spark, sf_dir, "events")
    hours = events.selectExpr("cast(ts as date) as d", "hour(ts) as h").distinct()
    if faultless:
        hours = hours.unionByName(hours.where("day(d) = 30").selectExpr("date_add(d, 1) as d", "h"))
    numbered = hours.selectExpr("add_months(d, 12) as partition_date", "day(d) as n", "h")
    return numbered.selectExpr(
        "concat(cast(partition_date as string), 'T', lpad(cast(h as string), 2, '0'), ':00') as time",
        "((n * 3 + h * 7) % 140) / 4D - 8 as temperature_2m",
        "(n * 5 + h * 3) % 101 as relative_humidity_2m",
        "((n * 3 + h * 7) % 140) / 4D - 11 as apparent_temperature",
        "((n * n + h) % 24) * (n % 4) * (n % 3) / 64D as precipitation",
        "((n * 11 + h) % 100) / 4D as wind_speed_10m",
        "(n * 17 + h * 15) % 360 as wind_direction_10m",
        f"element_at(array({WEATHER_CODES_USED}), (n * 7 + h) % {n_codes} + 1) as weather_code",
        "partition_date",
    )


# The 24 listed weather codes and, last, one that is not listed.
WEATHER_CODES_USED = (
    "0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 77, 80, 81, 82, 85, 86, 95, 96, 99, 100"
)


def raw_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones of their regions; nation 24 has no zone name, so it is dropped later."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    joined = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr(
        "n_nationkey as LocationID",
        "r_name as Borough",
        "if(n_nationkey < 24, n_name, null) as Zone",
        "if(n_nationkey % 3 = 0, 'Yellow Zone', 'Boro Zone') as service_zone",
    )


_RING = (
    "concat('[[', {x}, ',', {y}, '],[', {x} + {w}, ',', {y}, '],[', {x} + {w}, ',', {y} + {w},"
    " '],[', {x}, ',', {y} + {w}, '],[', {x}, ',', {y}, ']]')"
)


def published_zones(spark: SparkSession, sf_dir: str, faultless: bool = False) -> DataFrame:
    """Zone records with GeoJSON geometry: a square per nation, two parts for every fifth, a hole
    where key % 4 = 1, none at all for nation 3. Nation 24's polygon bears nation 0's name."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    named = nations.select(F.col("n_nationkey").alias("named_key"), F.col("n_name").alias("name"))
    joined = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).join(
        named, F.col("n_nationkey") % 24 == F.col("named_key")
    )
    square = _RING.format(x="(n_nationkey + 0.5D)", y="(n_nationkey * 2 + 0.25D)", w="1")
    hole = _RING.format(x="(n_nationkey + 0.75D)", y="(n_nationkey * 2 + 0.5D)", w="0.25D")
    second = _RING.format(x="(n_nationkey + 100.5D)", y="(n_nationkey * 2 + 0.25D)", w="1")
    rings = f"if(n_nationkey % 4 = 1, concat('[', {square}, ',', {hole}, ']'), concat('[', {square}, ']'))"
    return joined.selectExpr(
        "n_nationkey as LocationID",
        "r_name as borough",
        "name as zone",
        "n_nationkey * 0.5D as Shape_Area",
        f"""case when n_nationkey = {-1 if faultless else 3} then null
             when n_nationkey % 5 = 0 then
               concat('{{"type":"MultiPolygon","coordinates":[', {rings}, ',[', {second}, ']]}}')
             else concat('{{"type":"Polygon","coordinates":', {rings}, '}}') end as geometry""",
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_zone_lookup(raw_zone_lookup(spark, sf_dir))


def staged(
    spark: SparkSession, sf_dir: str, service: str, lookup: DataFrame | None = None, joined: DataFrame | None = None
):
    if lookup is None:
        lookup = broadcast_if_small(zone_lookup(spark, sf_dir))
    return staging.STAGERS[service](raw_trips(spark, sf_dir, service, joined=joined), lookup)


def all_staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lookup = broadcast_if_small(zone_lookup(spark, sf_dir))
    lines = stored_lines(spark, sf_dir)
    return {s: staged(spark, sf_dir, s, lookup, lines) for s in staging.SERVICES}


def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_weather(raw_weather(spark, sf_dir))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_geometry(published_zones(spark, sf_dir))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trips(all_staged(spark, sf_dir))


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue(all_staged(spark, sf_dir))


def weather_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.weather_impact(all_staged(spark, sf_dir), staged_weather(spark, sf_dir))


def trips_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trips_hourly(trips(spark, sf_dir))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.weather_daily(weather_impact(spark, sf_dir))


def zones_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.zones_geo(polygons(spark, sf_dir), revenue(spark, sf_dir))
