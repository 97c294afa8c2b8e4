"""Publishing after the tests, monthly summaries, counts from footers, repeated rows in two phases."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.lake import MONTHS, ROWS, land_month, make_lake, raw_month
from tripmart.functions.codes import translate
from tripmart.operators import checks
from tripmart.operators.checks import ChecksFailed
from tripmart.operators.quality import Limits
from tripmart.operators.sinks import write_lake
from tripmart.paths import PARTITION, raw_path, under
from tripmart.plans import flows, marts
from tripmart.plans.registry import MODELS, Lake
from tripmart.plans.staging import SERVICES, STAGERS
from tripmart.sources.lake import counted_by_footers, footer_counts, list_files, list_partitions, path_exists


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Landed files with their staging tables. To be read only."""
    lake = make_lake(spark, str(tmp_path_factory.mktemp("upkeep")), weather_days=5)
    lake.build("stg_taxi_zone_lookup")
    lake.build("stg_weather")
    for name in ("stg_yellow_taxi", "stg_green_taxi", "stg_app_rides", "stg_high_volume_fhv"):
        lake.build(name)
    return lake


def own_models(spark, staged, tmp_path) -> Lake:
    """The staged files under a lake whose final tables can be changed."""
    lake = Lake(spark, staged.source_base, str(tmp_path / "models"))
    for name in ("stg_taxi_zone_lookup", "stg_weather", "stg_yellow_taxi", "stg_green_taxi", "stg_app_rides", "stg_high_volume_fhv"):
        location = MODELS[name]
        write_lake(staged.read(name), lake.location(name), location.partition_by)
    return lake


# --- write, audit, publish ------------------------------------------------------------------


def test_a_failing_month_leaves_the_table_alone(spark, tmp_path):
    lake = make_lake(spark, str(tmp_path), MONTHS[:2], weather_days=1)
    flows.build_zones(lake)
    flows.build_staging(lake, "green_taxi")
    before = rows(lake.read("stg_green_taxi"))
    files = rows(list_files(spark, lake.location("stg_green_taxi")))
    land_month(spark, str(tmp_path), "green_taxi", MONTHS[1], rows=50)
    lake.build("stg_green_taxi", [MONTHS[1]], pending=True)
    with pytest.raises(ChecksFailed, match="not_null_pickup_datetime"):
        broken = lake.read_pending("stg_green_taxi", [MONTHS[1]]).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz"))
        flows.check_model(lake, "stg_green_taxi", rows=broken)
    assert rows(lake.read("stg_green_taxi")) == before
    assert rows(list_files(spark, lake.location("stg_green_taxi"))) == files


def test_flow_stops_before_publishing(spark, staged, tmp_path, monkeypatch):
    """Final tables keep the old month, and the next run builds it again."""
    lake = own_models(spark, staged, tmp_path)
    assert flows.build_final(lake) == list(MONTHS)
    names = ("trips", "revenue", "trips_hourly", "weather_daily")
    before = {n: rows(lake.read(n)) for n in names}
    changed = lake.read("stg_green_taxi", [MONTHS[1]]).where("total_amount > 20")
    write_lake(changed, lake.location("stg_green_taxi"), months=[MONTHS[1]])
    faulty = dict(flows.suites.FINAL)
    faulty["revenue"] = [*faulty["revenue"], flows.suites.within("total_amount", 0, 1)]
    with monkeypatch.context() as patch:
        patch.setattr(flows.suites, "FINAL", faulty)
        with pytest.raises(ChecksFailed, match="revenue"):
            flows.build_final(lake)
    assert {n: rows(lake.read(n)) for n in names} == before
    assert flows.build_final(lake) == [MONTHS[1]]
    assert rows(lake.read("trips")) != before["trips"]
    assert not path_exists(spark, lake.pending_location("trips"))


def test_published_months_keep_their_write_times(spark, staged, tmp_path):
    lake = own_models(spark, staged, tmp_path)
    lake.build("trips")
    kept = rows(list_files(spark, lake.location("trips"), [MONTHS[0]]))
    lake.build("trips", [MONTHS[1]], pending=True)
    written = {r["modified"] for r in list_files(spark, lake.pending_location("trips")).collect()}
    whole = rows(lake.read_pending("trips", [MONTHS[1]]))
    lake.publish("trips", [MONTHS[1]])
    assert rows(lake.read("trips")) == whole
    assert {r["modified"] for r in list_files(spark, lake.location("trips"), [MONTHS[1]]).collect()} == written
    assert rows(list_files(spark, lake.location("trips"), [MONTHS[0]])) == kept
    assert list_partitions(spark, lake.location("trips")) == list(MONTHS)


# --- monthly summaries ----------------------------------------------------------------------


def test_small_marts_read_one_month_anew(spark, staged, tmp_path):
    lake = own_models(spark, staged, tmp_path)
    flows.build_final(lake)
    write_lake(lake.read("stg_green_taxi", [MONTHS[1]]).limit(7), lake.location("stg_green_taxi"), months=[MONTHS[1]])
    for name in ("revenue", "weather_impact"):
        lake.build(name, [MONTHS[1]])
    for mart, source in (("zones_geo", "revenue"), ("weather_daily", "weather_impact")):
        summary = MODELS[mart].summaries[source]
        scans = [x for x in plan_of(summary.build(lake.read(source, [MONTHS[1]]))).splitlines() if "FileScan parquet" in x]
        assert len(scans) == 1 and "InMemoryFileIndex(1 paths)" in scans[0] and MONTHS[1] in scans[0]
        assert lake.refresh_summary(source, summary) == [MONTHS[1]]
        assert lake.refresh_summary(source, summary) == []
        files = lake.plan(mart).inputFiles()
        assert any(f"summaries/{summary.name}" in f for f in files) and not any(f"final/{source}/" in f for f in files)
        lake.build(mart)
    revenue, impact = lake.read("revenue"), lake.read("weather_impact")
    polygons = lake._input("reference.taxi_zones_geo", None)
    assert rows(lake.read("zones_geo")) == rows(marts.zones_geo(polygons, revenue))
    assert rows(lake.read("weather_daily")) == rows(marts.weather_daily(impact))


def test_months_that_left_a_mart_leave_its_summary(spark, staged, tmp_path):
    lake = own_models(spark, staged, tmp_path)
    for name in ("revenue", "zones_geo"):
        lake.build(name)
    kept = spark.createDataFrame(lake.read("revenue", [MONTHS[0]]).collect(), MODELS["revenue"].schema)
    write_lake(kept, lake.location("revenue"))
    lake.build("zones_geo")
    assert lake.read("zones_geo").agg(F.max("trip_count")).first()[0] <= kept.count()
    assert rows(lake.read("zones_geo")) == rows(marts.zones_geo(lake._input("reference.taxi_zones_geo", None), kept))


def test_a_zone_without_prices(spark):
    schema = "pickup_zone string, total_amount double, partition_date date"
    months = spark.createDataFrame([("a", None, date(2025, 1, 1)), ("a", None, date(2025, 2, 1)), ("b", 2.0, date(2025, 1, 1))], schema)
    assert rows(marts.fold_zone_revenue(marts.monthly_zone_revenue(months))) == rows(marts.revenue_by_zone(months))


# --- counts from footers --------------------------------------------------------------------


def test_footers_answer_counts(spark, staged):
    location, schema = staged.location("stg_green_taxi"), MODELS["stg_green_taxi"].schema
    columns = ["pickup_zone", "tip_amount"]
    plan = plan_of(counted_by_footers(spark, location, schema, columns=columns))
    assert "PushedAggregation: [COUNT(*), COUNT(pickup_zone), COUNT(tip_amount)]" in plan and f"PushedGroupBy: [{PARTITION}]" in plan
    scanned = staged.read("stg_green_taxi").groupBy(PARTITION).agg(F.count(F.lit(1)).alias("row_count"), *[F.count(c).alias(c) for c in columns])
    assert rows(footer_counts(spark, location, schema, columns=columns)) == rows(scanned)
    one = footer_counts(spark, location, schema, [MONTHS[1]], columns).collect()
    assert [r["row_count"] for r in one] == [ROWS]


def test_earlier_volumes_come_from_footers(spark, tmp_path):
    """A month three times as large as those before fails, and only this month is scanned."""
    lake = make_lake(spark, str(tmp_path), weather_days=1)
    for month in MONTHS[:2]:  # other columns in another order
        land_month(spark, str(tmp_path), "app_rides", month, change=lambda df: df.select(*reversed(df.columns)).withColumn("new", F.lit(1)))
    assert flows.check_raw(lake, "app_rides", [MONTHS[2]]) == []
    land_month(spark, str(tmp_path), "app_rides", MONTHS[2], rows=3 * ROWS)
    with pytest.raises(ChecksFailed, match="partition_volume_partition_date: 1"):
        flows.check_raw(lake, "app_rides", [MONTHS[2]])
    assert flows.check_raw(lake, "app_rides", [MONTHS[0]]) == []
    location = under(str(tmp_path), raw_path("app_rides"))
    found = footer_counts(spark, location, "dispatching_base_num string, partition_date date")
    assert [r["row_count"] for r in found.orderBy(PARTITION).collect()] == [ROWS, ROWS, 3 * ROWS]


# --- repeated rows --------------------------------------------------------------------------


def test_repeated_rows_in_two_phases(spark):
    once = spark.range(1000).selectExpr("id", "concat('text ', id) AS text", "if(id % 3 = 0, null, id / 7) AS x")
    assert checks.duplicate_rows(once).collect() == []
    exchanges = [x for x in plan_of(checks.repeated_hashes(once)).splitlines() if "HashAggregate" in x]
    assert all("text#" not in x.partition("output=")[2] for x in exchanges)
    twice = once.unionByName(once.where("id < 10")).unionByName(once.where("id < 4")).withColumn("z", F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0))
    assert [r[0] for r in checks.duplicate_rows(twice).collect()] == [14]
    plan = plan_of(checks.duplicate_rows(twice))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
    assert checks.duplicate_rows(once.where("id < 0")).collect() == []


def test_rows_of_one_hash_are_told_apart(spark, monkeypatch):
    """Were all hashes equal, whole rows would still decide."""
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("bigint") + F.col("a") * 0 if isinstance(columns[0], str) else F.lit(7).cast("bigint") + columns[0] * 0)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (2, None)], "a int, b string")
    assert [r[0] for r in checks.duplicate_rows(df).collect()] == [2]


# --- reconciliation by month ----------------------------------------------------------------


def test_months_are_reconciled_one_by_one(spark, staged, tmp_path):
    """Errors of two months that cancel out in the totals are found, in the built months only."""
    lake = own_models(spark, staged, tmp_path)
    flows.build_final(lake)
    assert rows(flows.unreconciled_months(lake, list(MONTHS))) == []
    hourly = lake.read("trips_hourly")
    sign = F.when(F.col(PARTITION) == date.fromisoformat(MONTHS[0]), 1).when(F.col(PARTITION) == date.fromisoformat(MONTHS[1]), -1).otherwise(0)
    first = hourly.groupBy(PARTITION).agg(F.min("pickup_hour").alias("first"))
    moved = hourly.join(first, PARTITION).groupBy("pickup_hour", PARTITION).agg(F.sum("trips").alias("trips"), F.max("first").alias("first"))
    moved = moved.withColumn("trips", F.col("trips") + F.when(F.col("pickup_hour") == F.col("first"), sign).otherwise(0))
    flows.reconcile(lake, trips_hourly=moved)  # the totals still agree
    found = rows(flows.unreconciled_months(lake, list(MONTHS), trips_hourly=moved))
    assert [(m, day.isoformat(), n - of) for m, day, n, of in found] == [("trips_hourly", MONTHS[0], 1), ("trips_hourly", MONTHS[1], -1)]
    assert rows(flows.unreconciled_months(lake, [MONTHS[2]], trips_hourly=moved)) == []
    with pytest.raises(ChecksFailed, match="trips_hourly"):
        flows.reconcile(lake, [MONTHS[1]], trips_hourly=moved)
    fewer = lake.read("weather_daily").withColumn("trips", F.col("trips") - 1)
    whole = rows(flows.unreconciled_months(lake, [MONTHS[0]], weather_daily=fewer))
    assert [(r[0], r[1]) for r in whole] == [("weather_daily", None)]
    gone = rows(flows.unreconciled_months(lake, [MONTHS[2]], trips_hourly=hourly.where(F.col(PARTITION) < date.fromisoformat(MONTHS[2]))))
    assert [(r[0], r[2]) for r in gone] == [("trips_hourly", 0)]


def test_built_months_are_tested_by_default(spark, staged, tmp_path, monkeypatch):
    lake = own_models(spark, staged, tmp_path)
    flows.build_final(lake)
    write_lake(lake.read("stg_green_taxi", [MONTHS[1]]).limit(9), lake.location("stg_green_taxi"), months=[MONTHS[1]])
    tested = {}

    def seen(lake, name, months=None, rows=None):
        tested[name] = sorted({r[0].isoformat() for r in rows.select(PARTITION).distinct().collect()} if PARTITION in rows.columns else [])

    monkeypatch.setattr(flows, "check_model", seen)
    assert flows.build_final(lake) == [MONTHS[1]]
    assert tested["trips"] == tested["trips_hourly"] == [MONTHS[1]] and len(tested) == 6


# --- limits of a build ----------------------------------------------------------------------


def test_a_build_follows_its_limits(spark, staged, tmp_path):
    """Narrower and wider limits than the usual ones, through the marts and their tests."""
    usual = own_models(spark, staged, tmp_path)
    flows.build_final(usual)
    narrow = replace(usual, limits=Limits(max_minutes=30, max_miles=10, max_fare=40))
    with pytest.raises(ChecksFailed, match="accepted_range_trip_duration_minutes"):
        flows.check_model(narrow, "trips")
    assert flows.build_final(narrow, full_refresh=True) == list(MONTHS)
    trips = narrow.read("trips")
    longest, farthest = trips.agg(F.max("trip_duration_minutes"), F.max("trip_distance_miles")).first()
    assert 20 < longest <= 30 and farthest == 10
    assert narrow.read("revenue").agg(F.max("total_amount")).first()[0] <= 40 + 2.5
    assert narrow.read("weather_impact").count() == trips.count()
    wide = replace(usual, limits=Limits(max_minutes=10_000, max_miles=10_000, max_fare=10_000))
    long = staged.read("stg_green_taxi").withColumns({"trip_duration_minutes": F.lit(900.0), "total_amount": F.lit(5000.0), "trip_distance_miles": F.lit(700.0)})
    write_lake(long, usual.location("stg_green_taxi"))
    assert wide.plan("trips").where("trip_duration_minutes = 900 and fare_amount = 5000").count() == long.count() > 0
    assert usual.plan("trips").where("trip_duration_minutes = 900").isEmpty()
    with pytest.raises(ValueError, match="no trip can meet"):
        Limits(min_minutes=5, max_minutes=4)


# --- raw columns with names of our own ------------------------------------------------------


@pytest.mark.parametrize("service", SERVICES)
def test_raw_columns_named_like_staged_ones(spark, service):
    raw = raw_month(spark, service, MONTHS[0])
    names = ["pickup_id", "DROPOFF_ID", "pickup_at", "dropoff_at", "vendor", "payment", "rate_code", "passengers", "location_id", "pickup_zone", "zone", "trip_duration_minutes"]
    declared = {c.lower() for c in raw.columns}
    more = raw.select("*", *[F.lit("x").alias(n) for n in names if n.lower() not in declared])
    lookup = spark.createDataFrame([(n, f"Borough {n}", f"Zone {n}", "s") for n in range(1, 6)], "location_id int, borough string, zone string, service_zone string")
    assert rows(STAGERS[service](more, lookup)) == rows(STAGERS[service](raw, lookup)) != []


def test_quotes_in_code_names(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "code int")
    assert [r[0] for r in df.select(translate("code", {1: "it's", 2: 'a\\"b'})).collect()] == ["it's", 'a\\"b', None, None]
