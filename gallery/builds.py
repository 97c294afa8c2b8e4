"""Data tests, staleness planning and flows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from gallery import fixture, stored
from gallery.registry import query
from tripmart.operators import checks
from tripmart.operators.checks import Check
from tripmart.paths import FINAL, PARTITION, RAW, STAGING, raw_path, under
from tripmart.plans import flows, registry, suites
from tripmart.plans.marts import stack
from tripmart.plans.staging import SERVICES
from tripmart.plans.staleness import stale_months
from tripmart.sources.lake import footer_counts, list_partitions, partition_times
from tripmart.workspace import new_workspace
from tripmart.plans.registry import MONTHLY_MARTS, STAGED_SERVICES, Lake

# --- single tests ---------------------------------------------------------------------------


@query(
    "v01_not_null",
    """SELECT VendorID, tpep_pickup_datetime, partition_date FROM raw_yellow
        WHERE tpep_dropoff_datetime IS NULL""",
)
def not_null(spark, sf_dir):
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi")
    failed = checks.failing_rows(rows, Check("not_null", "tpep_dropoff_datetime"))
    return failed.select("VendorID", "tpep_pickup_datetime", PARTITION)


@query(
    "v02_unique",
    """SELECT dispatching_base_num, count(*) AS n_records FROM raw_app
        WHERE dispatching_base_num IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
)
def unique(spark, sf_dir):
    rows = fixture.raw_trips(spark, sf_dir, "app_rides")
    return checks.repeated_values(rows, "dispatching_base_num")


@query(
    "v03_accepted_values",
    """SELECT hvfhs_license_num, pickup_datetime FROM raw_hv
        WHERE hvfhs_license_num NOT IN ('HV0002', 'HV0003', 'HV0004', 'HV0005')""",
)
def accepted_values(spark, sf_dir):
    check = suites.listed("hvfhs_license_num", "HV0002", "HV0003", "HV0004", "HV0005")
    rows = fixture.raw_trips(spark, sf_dir, "high_volume_fhv")
    return checks.failing_rows(rows, check).select("hvfhs_license_num", "pickup_datetime")


@query(
    "v04_relationships",
    """SELECT PULocationID, count(*) AS n_records FROM raw_yellow
        WHERE PULocationID NOT IN (SELECT location_id FROM zone_lookup) GROUP BY 1""",
)
def relationships(spark, sf_dir):
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi")
    lookup = fixture.zone_lookup(spark, sf_dir)
    return checks.missing_in_lookup(rows, "PULocationID", lookup, "location_id")


@query(
    "v05_accepted_range",
    "SELECT fare_amount FROM raw_yellow WHERE fare_amount < 0 OR fare_amount > 1000",
)
def accepted_range(spark, sf_dir):
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi")
    return checks.failing_rows(rows, suites.within("fare_amount", 0, 1000)).select("fare_amount")


_BASES = "SELECT dispatching_base_num, Affiliated_base_number, SR_Flag, partition_date FROM raw_app"


@query(
    "v06_duplicate_rows",
    f"""SELECT duplicate_rows FROM (SELECT
        (SELECT count(*) FROM ({_BASES})) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({_BASES})))
        AS duplicate_rows) WHERE duplicate_rows > 0""",
)
def no_duplicate_rows(spark, sf_dir):
    rows = fixture.raw_trips(spark, sf_dir, "app_rides")
    return checks.duplicate_rows(
        rows.select("dispatching_base_num", "Affiliated_base_number", "SR_Flag", PARTITION)
    )


@query(
    "v07_partition_volume",
    """WITH sizes AS (SELECT partition_date AS partition_value, count(*) AS row_count
            FROM raw_yellow GROUP BY 1),
        usual AS (SELECT *, avg(row_count) OVER (ORDER BY partition_value
            ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean FROM sizes)
        SELECT partition_value, row_count, round(mean) AS previous_avg FROM usual
        WHERE row_count < mean * 0.9 OR row_count > mean * 1.1""",
)
def partition_volume(spark, sf_dir):
    """With narrower limits than the default, so that more months stand out."""
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi")
    return checks.odd_volumes(rows, PARTITION, min_ratio=0.9, max_ratio=1.1)


_NULLABLE = ("pickup_datetime", "dropoff_datetime", "pickup_zone", "dropoff_zone", "total_amount")


@query(
    "v07_footer_counts",
    f"""SELECT partition_date, count(*) AS row_count, {", ".join(f"count({c}) AS {c}" for c in _NULLABLE)}
        FROM stg_yellow GROUP BY partition_date""",
)
def counts_from_footers(spark, sf_dir):
    """Volumes and non-NULL values of a stored table's months, without reading their rows."""
    lake = stored.staged_lake(spark, sf_dir)
    schema = registry.MODELS["stg_yellow_taxi"].schema
    return footer_counts(spark, lake.location("stg_yellow_taxi"), schema, columns=_NULLABLE)


@query(
    "v08_marts_reconcile",
    """SELECT 'weather_daily' AS mart, count(*) AS mart_trips, (SELECT count(*) FROM trips) AS trips
        FROM weather_impact HAVING count(*) <> (SELECT count(*) FROM trips)""",
)
def marts_reconcile(spark, sf_dir):
    """From the stored tables. Trips without a borough keep the weather mart from adding up."""
    lake = stored.built_lake(spark, sf_dir)
    return checks.unreconciled(
        lake.read("trips"),
        trips_hourly=lake.read("trips_hourly"),
        weather_daily=lake.read("weather_daily"),
    )


@query(
    "v08_months_reconcile",
    """WITH impact AS (SELECT partition_date, count(*) AS n FROM weather_impact GROUP BY 1),
        months AS (SELECT partition_date, count(*) AS n FROM trips GROUP BY 1)
        SELECT 'weather_daily' AS mart, i.partition_date AS partition_value, i.n AS mart_trips,
            coalesce(m.n, 0) AS trips
        FROM impact i LEFT JOIN months m USING (partition_date) WHERE i.n <> coalesce(m.n, 0)""",
)
def months_reconcile(spark, sf_dir):
    """The same by month: trips counted by footers, the weather mart by its monthly summary."""
    lake = stored.built_lake(spark, sf_dir)
    return flows.unreconciled_months(lake, list_partitions(spark, lake.location("weather_impact")))


# --- all declared tests ---------------------------------------------------------------------

_SOURCES = {
    (RAW, "yellow_taxi"): "raw_yellow",
    (RAW, "green_taxi"): "raw_green",
    (RAW, "app_rides"): "raw_app",
    (RAW, "high_volume_fhv"): "raw_hv",
    (RAW, "taxi_zone_lookup"): "raw_zones",
    (STAGING, "yellow_taxi"): "stg_yellow",
    (STAGING, "green_taxi"): "stg_green",
    (STAGING, "app_rides"): "stg_app",
    (STAGING, "high_volume_fhv"): "stg_hv",
    (STAGING, "weather"): "stg_weather",
    (STAGING, "taxi_zone_lookup"): "zone_lookup",
    **{(FINAL, t): t for t in suites.FINAL},
}


def _expected_failures(check: Check, source: str) -> str:
    c, a = check.column, check.arguments
    if check.kind == "not_null":
        return f"SELECT count(*) - count({c}) FROM {source}"
    if check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in a["values"])
        return f"SELECT count(*) FROM {source} WHERE {c} NOT IN ({listed})"
    if check.kind == "accepted_range":
        low = "false" if a["minimum"] is None else f"{c} < {a['minimum']}"
        high = "false" if a["maximum"] is None else f"{c} > {a['maximum']}"
        return f"SELECT count(*) FROM {source} WHERE {low} OR {high}"
    if check.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {c} FROM {source} GROUP BY {c} HAVING count({c}) > 1)"
    if check.kind == "relationships":
        return f"SELECT count(*) FROM {source} WHERE {c} NOT IN (SELECT LocationID FROM raw_zones)"
    if check.kind == "no_duplicate_rows":
        return (
            f"SELECT (SELECT count(*) FROM {source}) - "
            f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))"
        )
    return f"""SELECT count(*) FROM (SELECT count(*) AS n, avg(count(*)) OVER (ORDER BY {c}
        ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean FROM {source} GROUP BY {c})
        WHERE n < mean / 2 OR n > mean * 2"""


def _suite(layer: str) -> dict[str, list[Check]]:
    return {RAW: suites.RAW, STAGING: suites.STAGING, FINAL: suites.FINAL}[layer]


@query(
    "v09_gate",
    " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{check.name}' AS check_name, "
        f"'{check.severity}' AS severity, ({_expected_failures(check, source)}) AS failures"
        for (layer, table), source in _SOURCES.items()
        for check in _suite(layer)[table]
    ),
)
def all_checks(spark, sf_dir):
    """Every declared test of every table, on the faulty lake."""
    lake = stored.built_lake(spark, sf_dir)
    models = {(m.layer, m.table): m.name for m in registry.MODELS.values() if m.stored}
    lookups = {suites.LOOKUP: lake.read_raw(suites.LOOKUP)}
    results = []
    for layer, table in _SOURCES:
        rows = lake.read_raw(table) if layer == RAW else lake.read(models[layer, table])
        found = checks.run_checks(rows, _suite(layer)[table], lookups)
        results.append(
            found.select(
                F.lit(layer).alias("layer"),
                F.lit(table).alias("table_name"),
                F.col("check").alias("check_name"),
                "severity",
                "failures",
            )
        )
    return stack(results)


@query(
    "v09_unpublished_months",
    """SELECT partition_date, count(*) AS rows, count(total_amount) AS totals, false AS published
        FROM ok_stg_yellow GROUP BY partition_date""",
)
def unpublished_months(spark, sf_dir):
    """A table built anew from faulty files stops at the gate: readers still find the former months."""
    lake = stored.sandbox(spark, sf_dir)
    lake.build("stg_taxi_zone_lookup")
    flows.build_staging(lake, "yellow_taxi")
    faulty = Lake(spark, stored.landed(spark, sf_dir), lake.model_base)
    published = True
    try:
        flows.build_and_check(faulty, "stg_yellow_taxi")
        faulty.publish("stg_yellow_taxi")
    except checks.ChecksFailed:
        published = False
    return lake.read("stg_yellow_taxi").groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("total_amount").alias("totals"),
        F.lit(published).alias("published"),
    )


# --- planning -------------------------------------------------------------------------------


@query("i01_manifest", "SELECT DISTINCT partition_date, true AS has_time FROM raw_hv")
def manifest(spark, sf_dir):
    base = stored.landed(spark, sf_dir)
    times = partition_times(spark, under(base, raw_path("high_volume_fhv")))
    return times.select(PARTITION, F.col("modified").isNotNull().alias("has_time"))


def _times(rows, minimum):
    """A manifest whose write times follow the months' sizes; small months are missing."""
    counted = rows.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= minimum)
    written = F.timestamp_seconds(F.col("n") * 60)
    return counted.select(PARTITION, written.alias("modified"))


@query(
    "i02_stale",
    """WITH y AS (SELECT partition_date AS m, count(*) AS n FROM raw_yellow GROUP BY 1),
        g AS (SELECT partition_date AS m, count(*) AS n FROM raw_green GROUP BY 1),
        a AS (SELECT partition_date AS m, count(*) AS n FROM raw_app GROUP BY 1 HAVING n >= 50),
        h AS (SELECT partition_date AS m, count(*) AS n FROM raw_hv GROUP BY 1 HAVING n >= 100),
        s AS (SELECT m, max(n) AS n FROM (FROM y UNION ALL FROM g) GROUP BY m)
        SELECT s.m AS partition_date FROM s LEFT JOIN a ON a.m = s.m LEFT JOIN h ON h.m = s.m
        WHERE a.m IS NULL OR h.m IS NULL OR a.n < s.n OR h.n < s.n""",
)
def stale(spark, sf_dir):
    """Two sources and two targets with write times made from the months' row counts."""
    raw = {s: fixture.raw_trips(spark, sf_dir, s) for s in SERVICES}
    return stale_months(
        [_times(raw["yellow_taxi"], 0), _times(raw["green_taxi"], 0)],
        [_times(raw["app_rides"], 50), _times(raw["high_volume_fhv"], 100)],
    )


# --- flows ----------------------------------------------------------------------------------


def _months(lake: Lake, *names: str):
    """Rows per month of stored monthly tables."""
    return stack(
        [
            lake.read(n)
            .groupBy(F.lit(n).alias("table_name"), PARTITION)
            .agg(F.count(F.lit(1)).alias("rows"))
            for n in names
        ]
    )


def _months_sql(**sources: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, partition_date, count(*) AS rows FROM {source} GROUP BY ALL"
        for name, source in sources.items()
    )


_STAGED_SQL = {
    "stg_yellow_taxi": "ok_stg_yellow",
    "stg_green_taxi": "ok_stg_green",
    "stg_app_rides": "ok_stg_app",
    "stg_high_volume_fhv": "ok_stg_hv",
}
_MONTHLY_SQL = {m: f"ok_{m}" for m in MONTHLY_MARTS}


@query("i03_stage_flow", _months_sql(**_STAGED_SQL))
def stage_flow(spark, sf_dir):
    """Each service planned, tested, built and tested again; a second run finds nothing to do."""
    lake = stored.sandbox(spark, sf_dir)
    lake.build("stg_taxi_zone_lookup")
    lake.side_by_side(lambda s: flows.build_staging(lake, s), SERVICES)
    again = lake.side_by_side(lambda s: flows.build_staging(lake, s), SERVICES)
    if any(again.values()):
        raise AssertionError(f"built again: {again}")
    return _months(lake, *STAGED_SERVICES)


def _final_lake(spark, sf_dir) -> Lake:
    """Faultless staging in a sandbox, and the final tables built from it."""
    lake = stored.sandbox(spark, sf_dir)
    stored.build_all_staging(lake)
    flows.build_final(lake)
    return lake


_SMALL_SQL = """ UNION ALL SELECT 'weather_daily', NULL, count(*) FROM ok_weather_daily
    UNION ALL SELECT 'zones_geo', NULL, count(*) FROM ok_zones_geo"""


def _all_final(lake: Lake):
    small = [
        lake.read(n).agg(
            F.lit(n).alias("table_name"),
            F.lit(None).cast("date").alias(PARTITION),
            F.count(F.lit(1)).alias("rows"),
        )
        for n in registry.SMALL_MARTS
    ]
    return stack([_months(lake, *MONTHLY_MARTS), *small])


@query("i04_final_flow", _months_sql(**_MONTHLY_SQL) + _SMALL_SQL)
def final_flow(spark, sf_dir):
    """All marts; then one month of one service is staged anew, and only that month is built."""
    lake = _final_lake(spark, sf_dir)
    lake.build("stg_green_taxi", ["2025-03-01"])
    again = flows.build_final(lake)
    if again != ["2025-03-01"]:
        raise AssertionError(f"built again: {again}")
    return _all_final(lake)


@query("i05_weather_flow", "SELECT * FROM ok_stg_weather")
def weather_flow(spark, sf_dir):
    lake = stored.sandbox(spark, sf_dir)
    flows.build_weather(lake)
    flows.build_weather(lake)
    return lake.read("stg_weather")


@query(
    "i06_zone_flow",
    """SELECT l.location_id, l.zone, geometry_json FROM zone_lookup l
        JOIN ok_polygons p ON p.location_id = l.location_id""",
)
def zone_flow(spark, sf_dir):
    """The lookup is rebuilt each time, the polygons only once."""
    base = new_workspace(spark)
    stored.land_zones(fixture.raw_zone_lookup(spark, sf_dir), base)
    lake = Lake(spark, base)
    published = fixture.published_zones(spark, sf_dir, faultless=True)
    written = [
        flows.build_zones(lake, published),
        flows.build_zones(lake, published.withColumn("geometry", F.lit(None).cast("string"))),
    ]
    if written != [True, False]:
        raise AssertionError(f"polygons written: {written}")
    polygons = lake._input("reference.taxi_zones_geo", None)
    return lake.read("stg_taxi_zone_lookup").join(
        polygons.select("location_id", "geometry_json"), "location_id"
    ).select("location_id", "zone", "geometry_json")


@query("i07_history_load", _months_sql(**_STAGED_SQL, **_MONTHLY_SQL))
def history_load(spark, sf_dir):
    """Everything from landed files; the range's last month counts whole."""
    lake = stored.sandbox(spark, sf_dir)
    flows.load_history(lake, date(2025, 1, 10), date(2025, 1, 20))
    return _months(lake, *STAGED_SERVICES, *MONTHLY_MARTS)


@query(
    "i08_late_weather",
    """SELECT 'late weather' AS run, CAST(NULL AS DATE) AS partition_date WHERE false
        UNION ALL SELECT DISTINCT 'full refresh', partition_date FROM (
        SELECT partition_date FROM ok_stg_yellow UNION ALL SELECT partition_date FROM ok_stg_green
        UNION ALL SELECT partition_date FROM ok_stg_app
        UNION ALL SELECT partition_date FROM ok_stg_hv)""",
)
def late_weather(spark, sf_dir):
    """Months planned after the weather changed (none), and by a full refresh (all)."""
    lake = _final_lake(spark, sf_dir)
    lake.build("stg_weather")
    sources = [lake.location(s) for s in STAGED_SERVICES]
    targets = [lake.location(m) for m in MONTHLY_MARTS]
    planned = []
    for run, refresh in (("late weather", False), ("full refresh", True)):
        months = stale_months(
            [partition_times(spark, s) for s in sources],
            [partition_times(spark, t) for t in targets],
            refresh,
        )
        planned.append(months.select(F.lit(run).alias("run"), PARTITION))
    return stack(planned)
