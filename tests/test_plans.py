"""Marts, staleness, flows and the physical plans behind them."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.lake import MONTHS, land_day, land_month, make_lake, published_zones
from tripmart.operators import checks
from tripmart.operators.checks import ChecksFailed
from tripmart.operators.sinks import write_lake
from tripmart.paths import PARTITION, RAW, STAGING, FINAL
from tripmart.plans import flows, marts, registry, suites
from tripmart.plans.registry import MODELS, MONTHLY_MARTS, SMALL_MARTS, STAGED_SERVICES, Lake
from tripmart.plans.staging import SERVICES
from tripmart.plans.staleness import stale_months
from tripmart.sources import schemas
from tripmart.workspace import new_workspace


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Landed files shared by tests that leave them alone."""
    path = str(tmp_path_factory.mktemp("landed"))
    make_lake(spark, path)
    return path


@pytest.fixture(scope="module")
def lake(spark, base, tmp_path_factory):
    """The shared files with all tables built. To be read only."""
    own = Lake(spark, base, str(tmp_path_factory.mktemp("models")))
    for name in ("stg_taxi_zone_lookup", "stg_weather", *STAGED_SERVICES, *MONTHLY_MARTS, *SMALL_MARTS):
        own.build(name)
    return own


def rows(df):
    """Comparable rows; sums of doubles rounded."""
    plain = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted(plain, key=repr)


# --- schemas and registry -------------------------------------------------------------------


@pytest.mark.parametrize("name", [m.name for m in MODELS.values() if m.stored])
def test_model_schemas(lake, name):
    planned = lake.plan(name)
    assert {(f.name, f.dataType.simpleString()) for f in planned.schema} == {
        (f.name, f.dataType.simpleString())
        for f in lake.spark.createDataFrame([], MODELS[name].schema).schema
    }


def test_upstream_looks_through_unstored_models():
    assert registry.upstream_models(["trips"]) == list(STAGED_SERVICES)
    assert registry.upstream_models(["trips_hourly"]) == ["trips"]
    assert registry.upstream_models(["trips", "trips_hourly"]) == list(STAGED_SERVICES)
    assert set(registry.upstream_models(["weather_impact"])) == {*STAGED_SERVICES, "stg_weather"}
    assert registry.upstream_models(["zones_geo"]) == ["revenue"]


def test_layers():
    tables = registry.layer_tables()
    assert [len(tables[layer]) for layer in (RAW, STAGING, FINAL)] == [5, 6, 6]
    assert tables[STAGING]["taxi_zones_geo"] == "staging/reference/taxi_zones_geo"


class FakeSession:
    """Just the settings."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_workspace_is_in_the_shared_folder():
    shared = FakeSession(spark__checkpoint__dir="s3a://bucket/shared/", spark__master="yarn")
    assert new_workspace(shared, "x").startswith("s3a://bucket/shared/x-")
    assert new_workspace(shared) != new_workspace(shared)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_workspace(FakeSession(spark__master="yarn"))


# --- marts ----------------------------------------------------------------------------------


def hourly(spark, *data):
    full = [(datetime.fromisoformat(t), temp, rain, text) for t, temp, rain, text in data]
    return spark.createDataFrame(
        full,
        "datetime timestamp_ntz, temperature_c double, precipitation_mm double, weather_description string",
    ).withColumn("wind_speed_kmh", F.lit(10.0))


def test_day_without_noon_has_no_description(spark):
    days = marts.daily_weather(
        hourly(
            spark,
            ("2025-01-01 11:00:00", 1.0, 0.5, "Fog"),
            ("2025-01-02 12:00:00", 1.25, None, "Overcast"),
            ("2025-01-02 13:00:00", 1.25, None, "Fog"),
        )
    )
    got = {r["date"].day: r for r in days.collect()}
    assert got[1]["weather_description"] is None and got[1]["total_precipitation_mm"] == 0.5
    assert got[2]["weather_description"] == "Overcast"
    assert got[2]["total_precipitation_mm"] is None and got[2]["avg_temperature_c"] == 1.3


def test_fares_of_trips_and_revenue_differ(lake):
    joined = {}
    for name, amount in (("trips", "fare_amount"), ("revenue", "fare_amount")):
        df = lake.read(name).groupBy("taxi_type").agg(F.sum(amount).alias("s"))
        joined[name] = {r["taxi_type"]: r["s"] for r in df.collect()}
    yellow = lake.read("stg_yellow_taxi").agg(F.sum("total_amount"), F.sum("fare_amount")).first()
    assert (joined["trips"]["yellow_taxi"], joined["revenue"]["yellow_taxi"]) == tuple(yellow)
    assert joined["trips"]["app_rides"] is None and "app_rides" not in joined["revenue"]
    assert joined["trips"]["high_volume_fhv"] > joined["revenue"]["high_volume_fhv"]


def test_trips_keep_days_without_weather(spark, lake):
    known = lake.read("weather_impact").where("avg_temperature_c IS NULL").count()
    assert known == 0
    one_day = lake.read("stg_weather").where("partition_date = date'2025-01-05'")
    staged = {s: lake.read(f"stg_{s}") for s in SERVICES}
    impact = marts.weather_impact(staged, one_day)
    assert impact.count() == lake.read("weather_impact").count()
    assert {r[0].day for r in impact.where("avg_temperature_c IS NOT NULL").select("date").collect()} == {5}


def test_same_named_polygons_each_get_the_total(lake):
    zones = {r["location_id"]: r for r in lake.plan("zones_geo").collect()}
    assert zones[4]["zone"] == zones[5]["zone"]
    assert zones[4]["total_revenue"] == zones[5]["total_revenue"] > 0
    shown = sum(r["trip_count"] for r in zones.values() if r["location_id"] < 5)
    assert shown == lake.read("revenue").count()


def test_zone_without_revenue_shows_zeros(spark, lake):
    polygons = spark.createDataFrame(
        [(9, "B", "Nowhere", 1.0, None, "[]")], schemas.STAGING["taxi_zones_geo"]
    )
    row = marts.zones_geo(polygons, lake.read("revenue")).first()
    assert (row["trip_count"], row["total_revenue"], row["avg_fare"]) == (0, 0.0, 0.0)


def test_duration_counts_where_distance_is_known(spark):
    at = datetime(2025, 1, 1, 5, 59, 59)
    data = [
        (at, 10.0, "yellow_taxi", "Z", "B", 2.0, 5.0, date(2025, 1, 1)),
        (at, 30.0, "yellow_taxi", "Z", "B", None, None, date(2025, 1, 1)),
        (at, 7.0, "app_rides", "Z", "B", None, None, date(2025, 1, 1)),
    ]
    trips = spark.createDataFrame(
        data,
        "pickup_datetime timestamp_ntz, trip_duration_minutes double, taxi_type string, "
        "pickup_zone string, pickup_borough string, trip_distance_miles double, "
        "fare_amount double, partition_date date",
    )
    got = {r["taxi_type"]: r for r in marts.trips_hourly(trips).collect()}
    yellow, app = got["yellow_taxi"], got["app_rides"]
    assert yellow["pickup_hour"] == datetime(2025, 1, 1, 5)
    assert (yellow["trips"], yellow["fare_trips"], yellow["duration_minutes_with_distance"]) == (2, 1, 10.0)
    assert (app["revenue"], app["distance_miles"], app["duration_minutes_with_distance"]) == (None,) * 3


# --- staleness ------------------------------------------------------------------------------


def manifest(spark, **times):
    data = [(date(2025, int(m[1:]), 1), datetime(2025, 6, 1, t)) for m, t in times.items()]
    return spark.createDataFrame(data, f"{PARTITION} date, modified timestamp")


@pytest.mark.parametrize(
    "sources, targets, refresh, expected",
    [
        ([{"m1": 5}], [{}], False, [1]),
        ([{"m1": 5}], [{"m1": 4}], False, [1]),
        ([{"m1": 5}], [{"m1": 5}], False, []),
        ([{"m1": 5}], [{"m1": 6}], False, []),
        ([{"m1": 5}], [{"m1": 6}, {"m1": 4}], False, [1]),
        ([{"m1": 5}], [{"m1": 6}, {}], False, [1]),
        ([{"m1": 5}, {"m1": 7, "m2": 1}], [{"m1": 6, "m2": 2}], False, [1]),
        ([{"m2": 5, "m1": 5}], [{"m1": 9, "m2": 9}], True, [1, 2]),
        ([{"m1": 5}], [{"m1": 6, "m3": 1}], False, []),
    ],
)
def test_stale_months(spark, sources, targets, refresh, expected):
    found = stale_months(
        [manifest(spark, **s) for s in sources], [manifest(spark, **t) for t in targets], refresh
    )
    assert [r[0].month for r in found.collect()] == expected


# --- flows ----------------------------------------------------------------------------------


def test_month_by_month_equals_whole(spark, base, lake, tmp_path):
    parts = Lake(spark, base, str(tmp_path / "by_month"))
    parts.build("stg_taxi_zone_lookup")
    parts.build("stg_weather")
    for month in MONTHS:
        for name in (*STAGED_SERVICES, *MONTHLY_MARTS):
            parts.build(name, [month])
    for name in SMALL_MARTS:
        parts.build(name)
    for name in (*STAGED_SERVICES, *MONTHLY_MARTS, *SMALL_MARTS):
        assert rows(parts.read(name)) == rows(lake.read(name)), name


def test_flows_build_what_is_stale(spark, tmp_path):
    base = str(tmp_path)
    lake = make_lake(spark, base)
    assert not flows.build_zones(lake, published_zones(spark))
    flows.build_weather(lake)
    for service in SERVICES:
        assert flows.build_staging(lake, service) == list(MONTHS)
        assert flows.build_staging(lake, service) == []
    assert flows.build_final(lake) == list(MONTHS)
    assert flows.build_final(lake) == []
    before = rows(lake.read("trips").where("partition_date <> date'2025-02-01'"))

    land_month(spark, base, "green_taxi", "2025-02-01", rows=50)
    assert flows.build_staging(lake, "yellow_taxi") == []
    assert flows.build_staging(lake, "green_taxi", test_built_only=True) == ["2025-02-01"]
    assert flows.build_final(lake, test_built_only=True) == ["2025-02-01"]
    assert rows(lake.read("trips").where("partition_date <> date'2025-02-01'")) == before
    green = lake.read("trips").where("taxi_type = 'green_taxi' AND partition_date = date'2025-02-01'")
    assert green.count() == 50

    # Late weather marks no month stale, a full refresh takes them all
    land_day(base, date(2025, 1, 5), rain=99.0)
    flows.build_weather(lake)
    assert flows.build_final(lake) == []
    assert flows.build_final(lake, full_refresh=True) == list(MONTHS)
    rainy = lake.read("weather_daily").where("total_precipitation_mm = 99.0")
    assert [r["date"] for r in rainy.collect()] == [date(2025, 1, 5)]

    # A mart that lacks a month is a reason to build it
    kept = lake.read("revenue", list(MONTHS[:2])).collect()
    write_lake(spark.createDataFrame(kept, MODELS["revenue"].schema), lake.location("revenue"))
    assert MONTHS[2] in flows.build_final(lake)


def test_broken_raw_files_stop_the_build(spark, tmp_path):
    base = str(tmp_path)
    lake = make_lake(spark, base, MONTHS[:1], weather_days=1)
    flows.build_zones(lake)
    land_month(
        spark,
        base,
        "yellow_taxi",
        MONTHS[0],
        change=lambda df: df.withColumn("PULocationID", F.lit(None).cast("bigint")),
    )
    with pytest.raises(ChecksFailed, match="not_null_PULocationID: 40"):
        flows.build_staging(lake, "yellow_taxi")
    assert flows.plan_months(spark, [lake.source_location("raw/yellow_taxi")], [lake.location("stg_yellow_taxi")]) == [MONTHS[0]]
    # Repeated app rides only warn
    land_month(spark, base, "app_rides", MONTHS[0], change=lambda df: df.unionByName(df))
    assert len(flows.check_raw(lake, "app_rides")) == 1
    assert flows.build_staging(lake, "app_rides") == [MONTHS[0]]


def test_history_load(spark, tmp_path):
    base = str(tmp_path)
    lake = make_lake(spark, base, weather_days=58)
    with pytest.raises(FileNotFoundError, match="2025-02-28"):
        flows.load_history(lake, date(2025, 1, 15), date(2025, 2, 3))
    land_day(base, date(2025, 2, 28))
    with pytest.raises(FileNotFoundError, match="no weather files for 2025-03-01"):
        flows.load_history(lake, date(2025, 1, 15), date(2025, 3, 3))
    names = {layer: f"history_{layer}" for layer in (RAW, STAGING, FINAL)}
    try:
        built = flows.load_history(lake, date(2025, 1, 15), date(2025, 2, 3), None, names)
        assert built["final"] == list(MONTHS) == built["yellow_taxi"]
        counts = {
            (layer, table): spark.table(f"{names[layer]}.{table}").count()
            for layer, tables in registry.layer_tables().items()
            for table in tables
        }
        assert len(counts) == 17 and all(counts.values())
        assert counts[RAW, "weather"] == 59 * 24
    finally:
        for name in names.values():
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_history_passes_over_unpublished_months(spark, tmp_path):
    lake = make_lake(spark, str(tmp_path), MONTHS[:1], weather_days=59)
    built = flows.load_history(lake, date(2025, 1, 1), date(2025, 2, 1))
    assert built["absent"] == [f"{service} 2025-02-01" for service in SERVICES]
    assert built["final"] == [MONTHS[0]] == built["green_taxi"]


def test_raw_tests_of_chosen_months(spark, tmp_path):
    base = str(tmp_path)
    lake = make_lake(spark, base)

    def no_zone(df):
        return df.withColumn("PULocationID", F.lit(None).cast("bigint"))

    land_month(spark, base, "yellow_taxi", MONTHS[0], change=no_zone)
    land_month(spark, base, "yellow_taxi", MONTHS[2], rows=100)
    with pytest.raises(ChecksFailed, match="not_null_PULocationID: 40, partition_volume_partition_date: 1"):
        flows.check_raw(lake, "yellow_taxi")
    assert flows.check_raw(lake, "yellow_taxi", MONTHS[1:2]) == []
    # The months before are there to compare with, but not tested
    with pytest.raises(ChecksFailed, match="raw yellow_taxi: partition_volume_partition_date: 1$"):
        flows.check_raw(lake, "yellow_taxi", MONTHS[2])


def test_months_between():
    assert flows.months_between(date(2024, 11, 20), date(2025, 2, 1)) == [
        "2024-11-01",
        "2024-12-01",
        "2025-01-01",
        "2025-02-01",
    ]


def test_sandbox_leaves_the_lake_alone(spark, base, tmp_path):
    sandbox = Lake(spark, base, str(tmp_path / "sandbox"))
    sandbox.build("stg_taxi_zone_lookup")
    sandbox.build("stg_app_rides", [MONTHS[0]])
    assert sandbox.read("stg_app_rides").count() == 40
    assert Lake(spark, base).location("stg_app_rides") != sandbox.location("stg_app_rides")


# --- physical plans -------------------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_does_not_shuffle(lake):
    for name in STAGED_SERVICES:
        plan = plan_of(lake.plan(name))
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan, name
        assert plan.count("BroadcastHashJoin") == 2


def test_trip_marts_do_not_shuffle(lake):
    for name in ("trips", "revenue", "weather_impact"):
        plan = plan_of(lake.plan(name, [MONTHS[0]]))
        assert "SortMergeJoin" not in plan
        # the weather mart's only shuffle is of hourly weather
        assert plan.count("Exchange hashpartitioning") == (1 if name == "weather_impact" else 0)


@pytest.mark.parametrize("service", SERVICES)
def test_raw_tests_take_one_scan(spark, lake, service):
    """Repeated rows alone need another."""
    suite = [c for c in suites.RAW[service] if c.kind != "no_duplicate_rows"]
    lookups = {suites.LOOKUP: lake.read_raw(suites.LOOKUP)}
    assert plan_of(checks.run_checks(lake.read_raw(service), suite, lookups)).count("FileScan parquet") == 1


def test_months_and_columns_reach_the_scan(lake):
    plan = plan_of(lake.plan("revenue", [MONTHS[1]]))
    for line in [x for x in plan.splitlines() if "FileScan parquet" in x]:
        assert "2025-02-01" in re.search(r"PartitionFilters: \[(.*?)\]", line).group(1)
        read = re.search(r"ReadSchema: (.*)", line).group(1)
        assert "dropoff" not in read and "vendor" not in read


def test_hourly_mart_aggregates_before_the_shuffle(lake):
    plan = plan_of(lake.plan("trips_hourly"))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_no_python_in_any_plan(lake):
    for name in (*STAGED_SERVICES, *MONTHLY_MARTS):
        plan = plan_of(lake.plan(name))
        assert "Python" not in plan and "Pandas" not in plan


def test_weather_without_zone_shift(spark, lake):
    weather = lake.read("stg_weather").where("partition_date = date'2025-03-09'")
    assert sorted(r["datetime"].hour for r in weather.collect()) == list(range(24))
