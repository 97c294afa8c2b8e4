"""Datasets, filters and charts on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripmart.functions.labels import ZERO_WIDTH
from tripmart.plans import dashboard
from tripmart.plans.dashboard import Filters
from tripmart.sources import schemas

JAN, FEB = date(2025, 1, 1), date(2025, 2, 1)


@pytest.fixture(scope="module")
def tables(spark):
    hourly = [
        (datetime(2025, 1, 6, 7), "yellow_taxi", "Queens", "A", 10, 200.0, 10, 40.0, 120.0, JAN),
        (datetime(2025, 1, 7, 8), "high_volume_fhv", "Bronx", "B", 5, 150.0, 5, 30.0, 60.0, JAN),
        (datetime(2025, 1, 7, 8), "app_rides", "Bronx", "B", 3, None, 0, None, None, JAN),
        (datetime(2025, 2, 1, 0), "green_taxi", "Queens", "C", 2, 150.0, 2, 0.0, 0.0, FEB),
    ]
    days = [
        (date(2025, 1, 6), "Weekday", None, None, 0.0, None, 100),
        (date(2025, 1, 13), "Weekday", None, None, 0.9, None, 200),
        (date(2025, 1, 20), "Weekday", None, None, 6.0, None, 75),
        (date(2025, 1, 27), "Weekday", None, None, None, None, 300),
        (date(2025, 1, 7), "Weekday", None, None, 20.0, None, 80),
    ]
    zones = [
        (1, "Queens", "A", "[1]", 3, 6_000_000.0, 1.0),
        (2, "Queens", "B", "[2]", 3, 470_000_000.0, 1.0),
        (3, "Bronx", "C", "[3]", 3, 500_000_000.0, 1.0),
        (4, "Bronx", "D", None, 3, 7.0, 1.0),
        (5, "Bronx", "E", "[5]", 0, 0.0, 0.0),
    ]
    return {
        "trips_hourly": spark.createDataFrame(hourly, schemas.FINAL["trips_hourly"]),
        "weather_daily": spark.createDataFrame(days, schemas.FINAL["weather_daily"]),
        "zones_geo": spark.createDataFrame(zones, schemas.FINAL["zones_geo"]),
    }


def only(df):
    return tuple(df.first())[0]


def test_totals_and_ratios(tables):
    assert only(dashboard.chart("total_trips", tables)) == 20
    assert only(dashboard.chart("revenue", tables)) == 500.0
    assert only(dashboard.chart("average_fare", tables)) == 500.0 / 17
    assert only(dashboard.chart("revenue_per_mile", tables)) == 500.0 / 70


def test_nothing_to_divide_by_gives_null(tables):
    only_app = Filters(services=("Other for-hire",))
    assert only(dashboard.chart("average_fare", tables, only_app)) is None
    assert only(dashboard.chart("revenue_per_mile", tables, Filters(services=("Green",)))) is None
    empty = Filters(boroughs=("Nowhere",))
    assert only(dashboard.chart("total_trips", tables, empty)) is None


def test_speed_has_its_own_period_unless_one_is_chosen(tables):
    rows = [tuple(r) for r in dashboard.chart("speed_by_hour", tables).collect()]
    assert rows == [("00h", None), ("07h", 20.0), ("08h", 30.0)]
    chosen = Filters(period=(datetime(2025, 1, 7), None))
    rows = dashboard.chart("speed_by_hour", tables, chosen).collect()
    assert [r["hour_label"] for r in rows] == ["00h", "08h"]


def test_period_is_half_open(tables):
    def trips(first, end):
        return only(dashboard.chart("total_trips", tables, Filters(period=(first, end))))

    assert trips(datetime(2025, 1, 7, 8), None) == 10
    assert trips(None, datetime(2025, 1, 7, 8)) == 10
    assert trips(datetime(2025, 1, 7, 8), datetime(2025, 2, 1)) == 8
    assert trips(date(2025, 2, 1), datetime(2025, 2, 1, 0, 1)) == 2


def test_filters_apply_where_their_column_exists(tables):
    filters = Filters(services=("Yellow", "Green"), boroughs=("Queens",))
    assert only(dashboard.chart("total_trips", tables, filters)) == 12
    assert dashboard.chart("zone_map", tables, filters).count() == 4
    assert dashboard.chart("rain_effect", tables, filters).count() == 2


def test_top_zones(tables):
    rows = [tuple(r) for r in dashboard.chart("top_zones", tables).collect()]
    assert rows == [("A", 200.0), ("B", 150.0), ("C", 150.0)]


def test_heatmap(tables):
    rows = [tuple(r) for r in dashboard.chart("hour_by_weekday", tables).collect()]
    assert rows == [
        ("00h", ZERO_WIDTH * 5 + "Sat", 2),
        ("07h", "Mon", 10),
        ("08h", ZERO_WIDTH + "Tue", 8),
    ]


def test_share(tables):
    rows = dashboard.chart("service_share", tables).collect()
    assert [(r["taxi_type_label"], r["share"]) for r in rows] == [
        ("Yellow", 0.5),
        ("Uber/Lyft", 0.25),
        ("Other for-hire", 0.15),
        ("Green", 0.1),
    ]
    assert {r["bar"] for r in rows} == {"All trips"}


def test_map_buckets(tables):
    buckets = {r["zone"]: r["bucket"] for r in dashboard.chart("zone_map", tables).collect()}
    assert buckets == {"A": 2, "B": 6, "C": None, "E": 1}


def test_rain_against_dry_days_of_the_weekday(tables):
    days = {r["date"].day: r for r in dashboard.dataset("rain_intensity_daily", tables).collect()}
    # Mondays: dry days saw 100 and 200 trips
    assert days[20]["vs_dry_same_weekday"] == -0.5
    assert days[27]["vs_dry_same_weekday"] == 1.0
    assert days[27]["rain_intensity"].endswith("Heavy rain (15+ mm)")
    # no Tuesday was dry
    assert days[7]["vs_dry_same_weekday"] is None
    effect = {r[0].strip(ZERO_WIDTH): r[1] for r in dashboard.chart("rain_effect", tables).collect()}
    assert effect == {"Moderate rain (5–15 mm)": -0.5, "Heavy rain (15+ mm)": None}


def test_the_baseline_does_not_depend_on_the_period(tables):
    january_20 = Filters(period=(date(2025, 1, 20), date(2025, 1, 21)))
    rows = dashboard.chart("rain_effect", tables, january_20).collect()
    assert [r["trips_vs_dry_day"] for r in rows] == [-0.5]


def test_clicks_filter_the_other_charts(tables):
    clicks = {"top_zones": "B"}
    assert dashboard.cross_filtered("top_zones", tables, clicks).count() == 3
    assert only(dashboard.cross_filtered("total_trips", tables, clicks)) == 8
    both = {"top_zones": "B", "service_share": "Uber/Lyft"}
    assert only(dashboard.cross_filtered("total_trips", tables, both)) == 5


def test_filter_values(tables):
    got = dashboard.filter_values("trips_hourly", "taxi_type_label", tables).collect()
    assert [r[0] for r in got] == ["Green", "Other for-hire", "Uber/Lyft", "Yellow"]


def test_a_period_prunes_months(spark, tables, tmp_path):
    location = str(tmp_path / "hourly")
    tables["trips_hourly"].write.partitionBy("partition_date").parquet(location)
    stored = spark.read.schema(schemas.FINAL["trips_hourly"]).parquet(location)
    period = Filters(period=(datetime(2025, 2, 1), datetime(2025, 3, 1)))
    df = dashboard.chart("total_trips", {"trips_hourly": stored}, period)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    assert only(df) == 2


def test_metric_table(tables):
    rows = dashboard.metric_table("trips_hourly", tables, ["pickup_borough"]).collect()
    speeds = {r["pickup_borough"]: r["avg_speed_mph"] for r in rows}
    assert speeds == {"Queens": 20.0, "Bronx": 30.0}


def test_no_rows_is_no_speed(tables):
    df = tables["trips_hourly"].where(F.lit(False))
    assert only(dashboard.chart("total_trips", {"trips_hourly": df})) is None
