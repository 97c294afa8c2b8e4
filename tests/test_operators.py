"""Quality rules, joins, sinks, catalog and data tests on hand-made rows."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import catalog, checks, dimensions, quality, sinks
from tripmart.operators.checks import ERROR, WARN, Check
from tripmart.paths import PARTITION, final_path, raw_path, staging_path
from tripmart.plans import suites
from tripmart.sources.lake import read_lake

# --- quality --------------------------------------------------------------------------------

TRIP = (
    "pickup_datetime timestamp_ntz, trip_duration_minutes double, trip_distance_miles double, "
    "total_amount double, partition_date date"
)


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({0: datetime(2025, 2, 1)}, False),
        ({0: datetime(2025, 1, 31, 23, 59, 59)}, True),
        ({0: datetime(2025, 1, 1)}, True),
        ({0: datetime(2024, 12, 31, 23, 59)}, False),
        ({1: 1.0}, True),
        ({1: 0.99}, False),
        ({1: 240.0}, True),
        ({1: 240.1}, False),
        ({2: 100.0}, True),
        ({2: 100.1}, False),
        ({2: 0.0}, False),
        ({3: 1000.0}, True),
        ({3: 1000.01}, False),
        ({3: None}, False),
    ],
)
def test_clean_trip(spark, change, kept):
    row = [datetime(2025, 1, 15), 30.0, 5.0, 20.0, date(2025, 1, 1)]
    for place, value in change.items():
        row[place] = value
    df = spark.createDataFrame([tuple(row)], TRIP)
    assert df.where(quality.clean_trip("total_amount", True)).count() == kept


def test_limits_are_parameters(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 15), 300.0, 500.0, 5000.0, date(2025, 1, 1))], TRIP)
    assert df.where(quality.clean_trip()).count() == 0
    assert df.where(quality.clean_trip(max_minutes=300)).count() == 1


def test_unknown_passengers_pass(spark):
    df = spark.createDataFrame([(None,), (0,), (1,)], "n int")
    assert df.where(quality.unknown_or_positive(F.col("n"))).count() == 2


# --- joins ----------------------------------------------------------------------------------

LOOKUP = "location_id int, zone string, borough string"


def test_zones_of_both_ends(spark):
    trips = spark.createDataFrame([(1, 2), (2, 9)], "p int, d int")
    lookup = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y")], LOOKUP)
    rows = dimensions.with_zones(trips, lookup, "p", "d").orderBy("p").collect()
    assert [(r["pickup_zone"], r["dropoff_zone"], r["dropoff_borough"]) for r in rows] == [
        ("A", "B", "Y"),
        ("B", None, None),
    ]


def test_only_small_lookups_are_broadcast(spark, monkeypatch):
    lookup = spark.createDataFrame([(n, f"z{n}", "b") for n in range(50)], LOOKUP)
    trips = spark.range(100).selectExpr("cast(id as int) AS p", "cast(id as int) AS d")

    def plan(side):
        joined = dimensions.with_zones(trips, side, "p", "d")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(dimensions.broadcast_if_small(lookup))
    monkeypatch.setattr(dimensions, "BROADCAST_ROWS", 10)
    large = dimensions.broadcast_if_small(lookup)
    assert "strategy=broadcast" not in plan(large)
    assert dimensions.with_zones(trips, large, "p", "d").where("pickup_zone IS NULL").count() == 50


def test_hot_ids_of_a_large_lookup_are_joined_apart(spark, monkeypatch):
    lookup = spark.createDataFrame([(n, f"z{n}" if n % 7 else None, "b") for n in range(3000)], LOOKUP)
    # A third of the trips starts in zone 5, a third has no zone, and zone 3,001 and above are unknown
    trips = spark.range(30_000).selectExpr(
        "id",
        "cast(CASE id % 3 WHEN 0 THEN 5 WHEN 1 THEN NULL ELSE id % 4000 END AS int) AS p",
        "cast(CASE WHEN id % 2 = 0 THEN 7 ELSE id % 3500 END AS int) AS d",
    )
    wanted = dimensions.with_zones(trips, lookup, "p", "d")
    monkeypatch.setattr(dimensions, "BROADCAST_ROWS", 1000)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert dimensions.hot_ids(trips, "p") == [5]
        large = dimensions.broadcast_if_small(lookup)
        found = dimensions.with_zones(trips, large, "p", "d")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 2
        assert found.columns == wanted.columns
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1.5 * sum(sizes) / int(spark.conf.get("spark.sql.shuffle.partitions"))
        none = dimensions.with_zones(trips.where("id < 0"), large, "p", "d")
        assert none.isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# --- sinks ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, []),
        ("", []),
        ("2025-11-01, 2025-12-01", ["2025-11-01", "2025-12-01"]),
        (["2025-11-01", " "], ["2025-11-01"]),
        (date(2025, 12, 1), ["2025-12-01"]),
        ("2025-12-01", ["2025-12-01"]),
    ],
)
def test_month_argument(given, expected):
    assert sinks.parse_months(given) == expected


@pytest.mark.parametrize("given", ["2025-1-1", "2025-01-01x", ["january"]])
def test_bad_month_argument(given):
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        sinks.parse_months(given)


def rows_of(spark, **months):
    """`m01=3` gives three rows in January."""
    data = [(n, date(2025, int(m[1:]), 1)) for m, count in months.items() for n in range(count)]
    return spark.createDataFrame(data, "x int, partition_date date")


def stored(spark, location):
    df = read_lake(spark, location).groupBy(PARTITION).count()
    return {r[PARTITION].month: r["count"] for r in df.collect()}


def test_full_write_clears_old_months(spark, tmp_path):
    location = str(tmp_path / "t")
    sinks.write_lake(rows_of(spark, m01=2, m02=3), location)
    sinks.write_lake(rows_of(spark, m02=1), location)
    assert stored(spark, location) == {2: 1}


def test_month_write_leaves_others_and_emptied_months(spark, tmp_path):
    location = str(tmp_path / "t")
    sinks.write_lake(rows_of(spark, m01=2, m02=3, m03=4), location)
    sinks.write_lake(rows_of(spark, m01=9, m02=1), location, months="2025-02-01,2025-03-01")
    assert stored(spark, location) == {1: 2, 2: 1, 3: 4}


@pytest.mark.parametrize("regroup", [False, True])
def test_writing_twice_changes_nothing(spark, tmp_path, regroup):
    location = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_lake(rows_of(spark, m01=2, m02=3), location, regroup=regroup)
    assert stored(spark, location) == {1: 2, 2: 3}


def test_unpartitioned_is_one_file_and_ignores_months(spark, tmp_path):
    location = tmp_path / "t"
    sinks.replace_file(spark.range(100).repartition(8), str(location))
    sinks.write_lake(spark.range(5), str(location), None, months="2025-01-01")
    assert len(list(location.glob("*.parquet"))) == 1
    assert sinks.publish_view(spark, str(location), "five").count() == 5
    assert spark.table("five").count() == 5


def test_paths():
    assert raw_path("yellow_taxi", "2025-01-01", "f.parquet") == (
        "raw/yellow_taxi/partition_date=2025-01-01/f.parquet"
    )
    assert raw_path("weather") == "raw/weather"
    assert staging_path("weather", "2025-01-01") == "staging/weather/partition_date=2025-01-01"
    assert final_path("trips") == "final/trips"


# --- catalog --------------------------------------------------------------------------------


@pytest.fixture
def database(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_types():
    assert catalog.catalog_type(T.DecimalType(10, 2)) == "decimal(10,2)"
    assert catalog.catalog_type(T.TimestampNTZType()) == "timestamp_ntz"
    for refused in (
        T.ArrayType(T.IntegerType()),
        T.StructType([T.StructField("a", T.IntegerType())]),
        T.MapType(T.StringType(), T.StringType()),
        T.DayTimeIntervalType(),
    ):
        with pytest.raises(ValueError, match="scalar"):
            catalog.catalog_type(refused)


def test_columns_are_lower_case_first_spelling_wins_month_last():
    schema = T.StructType.fromDDL("partition_date date, Airport_fee double, airport_fee int, X string")
    assert catalog.catalog_columns(schema) == "`airport_fee` double, `x` string, `partition_date` date"


def test_nothing_to_register(spark, tmp_path, database):
    with pytest.raises(FileNotFoundError):
        catalog.create_external_table(spark, database, "t", str(tmp_path / "none"))
    with pytest.raises(ValueError, match="schema"):
        catalog.create_external_table(spark, database, "t", str(tmp_path), "json")


def test_repair_adds_and_drops_months(spark, tmp_path, database):
    location = str(tmp_path / "t")
    sinks.write_lake(rows_of(spark, m01=2, m02=3), location)
    catalog.repair_table(spark, database, "t", location)
    sinks.write_lake(rows_of(spark, m02=3, m03=1), location)
    catalog.repair_table(spark, database, "t", location)
    months = [r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.t").collect()]
    assert months == ["partition_date=2025-02-01", "partition_date=2025-03-01"]
    assert spark.table(f"{database}.t").count() == 4


def test_recreate_keeps_files_and_takes_new_columns(spark, tmp_path, database):
    location = str(tmp_path / "t")
    sinks.write_lake(rows_of(spark, m01=2), location)
    catalog.recreate_tables(spark, database, {"t": location})
    sinks.write_lake(rows_of(spark, m01=2).withColumn("New", F.lit(1.5)), location)
    catalog.recreate_tables(spark, database, {"t": location})
    assert spark.table(f"{database}.t").columns == ["x", "new", "partition_date"]
    assert spark.table(f"{database}.t").count() == 2


def test_unpartitioned_table(spark, tmp_path, database):
    location = str(tmp_path / "t")
    sinks.replace_file(spark.range(3), location)
    catalog.repair_table(spark, database, "t", location)
    sinks.replace_file(spark.range(7), location)
    catalog.repair_table(spark, database, "t", location)
    assert spark.table(f"{database}.t").count() == 7


# --- data tests -----------------------------------------------------------------------------

ALL = [
    *[(layer, t, c) for layer in ("RAW", "STAGING", "FINAL") for t, cs in getattr(suites, layer).items() for c in cs]
]


def test_number_of_declared_tests():
    count = {layer: sum(1 for a in ALL if a[0] == layer) for layer in ("RAW", "STAGING", "FINAL")}
    # one more spans models: the reconciliation
    assert count == {"RAW": 35, "STAGING": 40, "FINAL": 20}


def failing_and_passing(check):
    """Values of the column for which the test fails, and passes."""
    if check.kind == "not_null":
        return [None], ["x"]
    if check.kind == "accepted_values":
        return ["other"], [check.arguments["values"][0], None]
    if check.kind == "accepted_range":
        low, high = check.arguments["minimum"], check.arguments["maximum"]
        bad = [v for v in (None if low is None else low - 1, None if high is None else high + 1) if v is not None]
        return bad, [v for v in (low, high) if v is not None] + [None]
    if check.kind == "unique":
        return ["a", "a"], ["a", "b", None, None]
    if check.kind == "relationships":
        return ["99"], ["1", None]
    months = [date(2025, 1, 1) + timedelta(days=31 * n) for n in range(3)]
    if check.kind == "partition_volume":
        return [months[0]] * 10 + [months[1]] * 4, [months[0]] * 10 + [months[1]] * 5 + [months[2]] * 15
    return ["a", "a"], ["a", "b"]


@pytest.mark.parametrize("layer, table, check", ALL, ids=lambda x: getattr(x, "name", x))
def test_each_declared_test(spark, layer, table, check):
    column = check.column or "any_column"
    lookup = spark.createDataFrame([("1",)], "LocationID string")
    for data, fails in zip(failing_and_passing(check), (True, False)):
        sample = next((v for v in data if v is not None), "x")
        kind = {str: "string", date: "date", int: "double", float: "double"}[type(sample)]
        cast = [(float(v) if kind == "double" and v is not None else v,) for v in data]
        df = spark.createDataFrame(cast, f"{column} {kind}")
        result = checks.run_checks(df, [check], {suites.LOOKUP: lookup}).collect()
        assert [r["severity"] for r in result] == [check.severity]
        assert (result[0]["failures"] > 0) == fails


def test_gate_stops_on_errors_only(spark):
    df = spark.createDataFrame([(None,), (1,), (1,)], "x int")
    warned = checks.gate(checks.run_checks(df, [Check("no_duplicate_rows", severity=WARN)]), "t")
    assert [r["failures"] for r in warned] == [1]
    with pytest.raises(checks.ChecksFailed, match="not_null_x: 1"):
        checks.gate(checks.run_checks(df, [Check("not_null", "x", ERROR)]), "t")
    with pytest.raises(ValueError, match="unknown test"):
        checks.run_checks(df, [Check("other")])


def test_row_tests_share_one_scan(spark):
    df = spark.range(10).selectExpr("id AS a", "id AS b", "id AS c")
    found = [Check("not_null", "a"), Check("not_null", "b"), suites.within("c", 0, 5)]
    results = checks.count_row_failures(df, found)
    assert results._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert {r["check"]: r["failures"] for r in results.collect()} == {
        "not_null_a": 0,
        "not_null_b": 0,
        "accepted_range_c": 4,
    }


def test_volume_bounds(spark):
    """Exactly half and exactly double are usual; the first month is skipped."""
    sizes = {1: 8, 2: 4, 3: 12, 4: 3, 5: 20}
    df = rows_of(spark, **{f"m0{m}": n for m, n in sizes.items()})
    odd = {r["partition_value"].month: r["previous_avg"] for r in checks.odd_volumes(df, PARTITION).collect()}
    # 2: 4 against 8; 3: 12 against 6; 4: 3 against 8; 5: 20 against 19/3
    assert odd == {4: 8.0, 5: 6.0}


def test_reconciliation(spark):
    trips = spark.range(5)
    good = spark.createDataFrame([(2,), (3,)], "trips long")
    bad = spark.createDataFrame([(4,)], "trips long")
    rows = checks.unreconciled(trips, good=good, bad=bad).collect()
    assert [tuple(r) for r in rows] == [("bad", 4, 5)]
