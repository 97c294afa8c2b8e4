"""Readers: drifting raw months, weather, zones, polygons, listings."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators import catalog
from tripmart.paths import raw_path, staging_path, under
from tripmart.plans.staging import stage_zone_lookup
from tripmart.sources import polygons, raw, weather
from tripmart.sources.lake import list_partitions, partition_times, path_exists, read_lake


def write_month(spark, base, table, month, columns):
    """One row with the given SQL columns as a month's file."""
    df = spark.sql("SELECT " + ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items()))
    df.write.mode("overwrite").parquet(under(base, raw_path(table, month)))


@pytest.fixture
def drifting(spark, tmp_path):
    base = str(tmp_path)
    write_month(
        spark,
        base,
        "yellow_taxi",
        "2025-01-01",
        {
            "VendorID": "1",
            "PULocationID": "7",
            "passenger_count": "2L",
            "Airport_fee": "1.75D",
            "tpep_pickup_datetime": "timestamp_ntz'2025-01-05 10:00:00'",
        },
    )
    write_month(
        spark,
        base,
        "yellow_taxi",
        "2025-02-01",
        {
            "VendorID": "2L",
            "PULocationID": "8L",
            "passenger_count": "2.5D",
            "airport_fee": "1.25D",
            "cbd_fee": "0.75D",
        },
    )
    return base


def test_months_are_united_by_name(spark, drifting):
    df = raw.read_raw_trips(spark, drifting, "yellow_taxi")
    rows = {r["partition_date"]: r for r in df.collect()}
    first, second = rows[date(2025, 1, 1)], rows[date(2025, 2, 1)]
    assert (first["Airport_fee"], second["Airport_fee"]) == (1.75, 1.25)
    assert (first["passenger_count"], second["passenger_count"]) == (2.0, 2.5)
    assert (first["cbd_fee"], second["cbd_fee"]) == (None, 0.75)
    assert second["tpep_pickup_datetime"] is None
    assert dict(df.dtypes)["PULocationID"] == "bigint"


def test_only_the_asked_months_are_read(spark, drifting):
    df = raw.read_raw_trips(spark, drifting, "yellow_taxi", ["2025-02-01", "2025-03-01"])
    assert [r["VendorID"] for r in df.collect()] == [2]


def test_a_rewritten_month_is_read_with_its_new_layout(spark, drifting):
    raw.read_raw_trips(spark, drifting, "yellow_taxi").collect()
    write_month(spark, drifting, "yellow_taxi", "2025-01-01", {"VendorID": "1.0D", "extra": "3"})
    rows = raw.read_raw_trips(spark, drifting, "yellow_taxi").where("VendorID = 1").collect()
    assert [(r["extra"], r["Airport_fee"]) for r in rows] == [(3.0, None)]


def test_scans_follow_type_changes_not_months(spark, tmp_path):
    base = str(tmp_path)
    for month in range(1, 10):
        kind = "1" if month < 5 else "1L"
        extra = {f"new_{month}": "1"} if month % 2 else {}
        write_month(spark, base, "app_rides", f"2025-0{month}-01", {"DOlocationID": kind, **extra})
    root = under(base, raw_path("app_rides"))
    times = {
        f"{root}/partition_date={r[0]}": r[1] for r in partition_times(spark, root).collect()
    }
    groups = raw.compatible_groups(raw.month_layouts(spark, dict(sorted(times.items()))))
    assert [len(members) for _, members in groups] == [4, 5]


def test_no_files_gives_no_rows(spark, tmp_path):
    df = raw.read_raw_trips(spark, str(tmp_path), "green_taxi")
    assert df.count() == 0 and "lpep_pickup_datetime" in df.columns


def test_undeclared_columns_widen(spark):
    a = spark.sql("SELECT 1 AS x, 'a' AS y")
    b = spark.sql("SELECT 2.5D AS X, 3 AS y")
    from pyspark.sql import types as T

    df = raw.union_by_name([a, b], T.StructType([]))
    assert df.dtypes == [("x", "double"), ("y", "string")]


def test_weather_lines_and_day(spark, tmp_path):
    folder = tmp_path / "raw" / "weather" / "partition_date=2025-01-01"
    folder.mkdir(parents=True)
    (folder / "w.json").write_text(
        '{"time": "2025-01-01T00:00", "temperature_2m": 1.5, "weather_code": 3}\n'
        '{"time": "2025-01-01T01:00", "temperature_2m": null, "weather_code": 61}\n'
    )
    rows = raw.read_raw_weather(spark, str(tmp_path)).collect()
    assert [r["weather_code"] for r in rows] == [3, 61]
    assert {r["partition_date"] for r in rows} == {date(2025, 1, 1)}


def test_payload_ends_with_the_shortest_array(spark, tmp_path):
    names = list(raw.schemas.HOURLY_VARIABLES)
    hourly = {"time": ["a", "b", "c"], **{n: [1, 2, 3] for n in names}}
    hourly["weather_code"] = [1, 2]
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"latitude": 40.7, "hourly": hourly}, indent=1))
    rows = weather.hourly_rows(weather.read_weather_payload(spark, str(path))).collect()
    assert [(r["time"], r["weather_code"]) for r in rows] == [("a", 1), ("b", 2)]


def test_zone_lookup(spark, tmp_path):
    folder = tmp_path / "raw" / "reference" / "taxi_zone_lookup"
    folder.mkdir(parents=True)
    (folder / "l.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
        '2,"Queens",,"Boro Zone"\n264,"Unknown","N/A","N/A"\n'
    )
    lookup = stage_zone_lookup(raw.read_zone_lookup(spark, str(tmp_path)))
    assert [tuple(r) for r in lookup.orderBy("location_id").collect()] == [
        (1, "EWR", "Newark Airport", "EWR"),
        (264, "Unknown", "N/A", "N/A"),
    ]


def test_polygons(spark):
    square = [[0, 0], [1, 0], [1, 1.5], [0, 0]]
    hole = [[0.25, 0.25], [0.5, 0.25], [0.5, 0.5], [0.25, 0.25]]
    shapes = [
        {"type": "Polygon", "coordinates": [square, hole]},
        {"type": "MultiPolygon", "coordinates": [[square], [hole]]},
        None,
    ]
    df = spark.createDataFrame([(json.dumps(s) if s else None,) for s in shapes], "geometry string")
    got = df.select(
        polygons.rings_json(F.col("geometry")), polygons.well_known_text(F.col("geometry"))
    ).collect()
    assert json.loads(got[0][0]) == [square]
    assert json.loads(got[1][0]) == [square, hole]
    assert got[0][1] == "POLYGON ((0 0, 1 0, 1 1.5, 0 0), (0.25 0.25, 0.5 0.25, 0.5 0.5, 0.25 0.25))"
    assert got[1][1].startswith("MULTIPOLYGON (((0 0, 1 0, 1 1.5, 0 0)), ((")
    assert tuple(got[2]) == (None, None)


def test_listing(spark, tmp_path):
    base = str(tmp_path)
    location = under(base, staging_path("x"))
    assert partition_times(spark, location).count() == 0 and not path_exists(spark, location)
    df = spark.range(100).selectExpr("id", "date_add(date'2025-01-01', cast(id % 3 as int)) AS partition_date")
    df.repartition(4).write.partitionBy("partition_date").parquet(location)
    assert list_partitions(spark, location) == ["2025-01-01", "2025-01-02", "2025-01-03"]
    assert all(isinstance(r["modified"], datetime) for r in partition_times(spark, location).collect())
    assert read_lake(spark, location).schema["partition_date"].dataType.simpleString() == "date"


def test_listing_shows_data_files_only(spark, tmp_path):
    from tripmart.sources.lake import list_files

    location = str(tmp_path / "many")
    spark.range(64).repartition(64).selectExpr("id", "date'2025-01-01' AS partition_date").write.partitionBy(
        "partition_date"
    ).parquet(location)
    (tmp_path / "many" / "partition_date=2025-02-01").mkdir()
    (tmp_path / "many" / "partition_date=2025-01-01" / "_temporary").touch()
    written = list((tmp_path / "many" / "partition_date=2025-01-01").glob("*.parquet"))
    files = list_files(spark, location).collect()
    assert len(files) == len(written) and {r["partition_date"].isoformat() for r in files} == {"2025-01-01"}
    assert spark.read.parquet(*[r["path"] for r in files]).count() == 64
    assert list_files(spark, location, ["2025-02-01"]).count() == 0
    assert path_exists(spark, location) and not path_exists(spark, f"{location}/partition_date=2025-02-01")


def test_month_of_differing_files_keeps_all_columns(spark, tmp_path):
    """Columns of any file, types that differ between files, and codes with a fraction."""
    month = f"{tmp_path}/raw/yellow_taxi/partition_date=2025-01-01"
    first = spark.sql("SELECT 1.6D AS VendorID, 2L AS passenger_count, 5.0D AS Airport_fee")
    second = spark.sql("SELECT 2L AS VendorID, 3.0D AS passenger_count, 7 AS extra_column")
    first.write.mode("append").parquet(month)
    second.write.mode("append").parquet(month)
    rows = raw.read_raw_trips(spark, str(tmp_path), "yellow_taxi")
    assert [r.VendorID for r in rows.collect()] == [2, 2]
    fees = [c for c in rows.columns if c.lower() == "airport_fee"]
    assert rows.agg({fees[0]: "sum"}).first()[0] == 5.0 and rows.agg({"extra_column": "sum"}).first()[0] == 7


def test_months_are_checked_before_anything_is_read(spark, tmp_path):
    from tripmart.plans.registry import Lake

    lake = Lake(spark, str(tmp_path))
    for name in ("stg_yellow_taxi", "trips"):
        with pytest.raises(ValueError, match="YYYY-MM-DD"):
            lake.build(name, "2025-2-1")


def test_broken_weather_line_fails(spark, tmp_path):
    folder = tmp_path / "raw" / "weather" / "partition_date=2025-01-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"time": "2025-01-01T00:00", "weather_code": 61.0, "relative_humidity_2m": 80.0}\n')
    row = raw.read_raw_weather(spark, str(tmp_path)).first()
    assert (row.weather_code, row.relative_humidity_2m) == (61, 80)
    (folder / "a.json").write_text('{"time": "2025-01-01T00:00", "weath\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_raw_weather(spark, str(tmp_path)).collect()


def write_nanos(base, table: str, month: str, name: str, kind: str, **columns):
    """A Parquet file whose time columns have the given unit."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = f"{base}/raw/{table}/partition_date={month}"
    os.makedirs(folder, exist_ok=True)
    arrays = {c: pa.array(v, pa.timestamp(kind) if isinstance(v[0], datetime) else None) for c, v in columns.items()}
    pq.write_table(pa.table(arrays), f"{folder}/{name}.parquet")


@pytest.fixture
def nanosecond_lake(tmp_path):
    base, early, late = str(tmp_path), datetime(1969, 12, 31, 23, 59, 59, 7), datetime(2025, 3, 9, 2, 30)
    times = {"tpep_pickup_datetime": [late, None], "Extra_time": [early, late]}
    write_nanos(base, "yellow_taxi", "2025-01-01", "a", "us", VendorID=[1, 2], **times)
    write_nanos(base, "yellow_taxi", "2025-02-01", "a", "ns", VendorID=[3, 4], **times)
    write_nanos(base, "yellow_taxi", "2025-03-01", "a", "us", VendorID=[5, 6], **times)
    write_nanos(base, "yellow_taxi", "2025-03-01", "b", "ns", VendorID=[7.0, 8.0], **times)
    return base


def test_nanosecond_times(spark, nanosecond_lake):
    """A month of nanoseconds, and one that holds both units and two kinds of numbers."""
    df = raw.read_raw_trips(spark, nanosecond_lake, "yellow_taxi")
    assert dict(df.dtypes)["Extra_time"] == "timestamp_ntz"
    rows = df.orderBy("VendorID").collect()
    assert [r["VendorID"] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert {r["Extra_time"] for r in rows[::2]} == {datetime(1969, 12, 31, 23, 59, 59, 7)}
    assert {(r["tpep_pickup_datetime"], r["Extra_time"]) for r in rows[1::2]} == {(None, datetime(2025, 3, 9, 2, 30))}


def test_a_column_of_whole_numbers_is_no_time(spark, tmp_path):
    """Nanoseconds in one month and plain whole numbers of the same name in another do not share a scan."""
    base = str(tmp_path)
    write_nanos(base, "green_taxi", "2025-01-01", "a", "ns", lpep_pickup_datetime=[datetime(2025, 1, 1)], x=[1])
    write_nanos(base, "green_taxi", "2025-02-01", "a", "ns", lpep_pickup_datetime=[datetime(2025, 2, 1)], x=[datetime(2025, 1, 2)])
    groups = raw.layout_groups(spark, f"{base}/raw/green_taxi")
    assert len(groups) == 2
    rows = raw.read_raw_trips(spark, base, "green_taxi").orderBy("partition_date").collect()
    assert [r["x"] for r in rows] == ["1", "2025-01-02 00:00:00"]


def test_nanosecond_times_are_staged(spark, tmp_path):
    """The whole of a service in nanoseconds gives what microseconds give."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tests import lake as small

    micros, nanos = str(tmp_path / "us"), str(tmp_path / "ns")
    built = []
    for base in (micros, nanos):
        lake = small.make_lake(spark, base, weather_days=0)
        if base == nanos:
            for path in (tmp_path / "ns/raw/yellow_taxi").rglob("*.parquet"):
                table = pq.read_table(path, partitioning=None)
                wanted = [f.with_type(pa.timestamp("ns")) if pa.types.is_timestamp(f.type) else f for f in table.schema]
                pq.write_table(table.cast(pa.schema(wanted)), path)
                (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        lake.build("stg_taxi_zone_lookup")
        lake.build("stg_yellow_taxi")
        built.append(sorted(map(tuple, lake.read("stg_yellow_taxi").collect()), key=str))
    assert built[0] == built[1] and len(built[0]) == 3 * small.ROWS


def test_one_view_over_drifting_months(spark, nanosecond_lake, tmp_path):
    """The view follows the files: months come and go, tables of vanished layouts go too."""
    name = "views_of_drift"
    location = f"{nanosecond_lake}/raw/yellow_taxi"

    def rows():
        spark.catalog.refreshTable(f"{name}.yellow_taxi")
        return [r[0] for r in spark.table(f"{name}.yellow_taxi").orderBy("vendorid").select("vendorid").collect()]

    try:
        first = catalog.repair_layouts(spark, name, "yellow_taxi", location, raw.schemas.RAW["yellow_taxi"])
        view = spark.table(f"{name}.yellow_taxi")
        assert rows() == [1, 2, 3, 4, 5, 6, 7, 8] and dict(view.dtypes)["extra_time"] == "timestamp_ntz"
        assert view.where("extra_time < '1970-01-01'").count() == 4
        assert view.where("partition_date = date'2025-02-01'").count() == 2
        # The same table later: a month less and one more, elsewhere
        later, location = str(tmp_path / "later"), f"{tmp_path}/later/raw/yellow_taxi"
        for month, unit, ids in (("2025-01-01", "us", [1, 2]), ("2025-02-01", "ns", [3, 4])):
            write_nanos(later, "yellow_taxi", month, "a", unit, VendorID=ids, Extra_time=[datetime(2025, 1, 1)] * 2)
        write_nanos(later, "yellow_taxi", "2025-04-01", "a", "ns", VendorID=[9])
        second = catalog.repair_layouts(spark, name, "yellow_taxi", location, raw.schemas.RAW["yellow_taxi"])
        assert rows() == [1, 2, 3, 4, 9] and len(second) < len(first)
        assert catalog.repair_layouts(spark, name, "yellow_taxi", location, raw.schemas.RAW["yellow_taxi"]) == second
        listed = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {name}").collect()}
        assert listed == {"yellow_taxi", *second}
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_quote_in_the_path(spark, tmp_path):
    base = str(tmp_path / "it's")
    write_nanos(base, "yellow_taxi", "2025-01-01", "a", "us", VendorID=[1])
    try:
        catalog.recreate_tables(spark, "quoted", {"plain": f"{base}/raw/yellow_taxi"})
        catalog.repair_layouts(spark, "quoted", "view", f"{base}/raw/yellow_taxi")
        assert spark.table("quoted.plain").count() == spark.table("quoted.view").count() == 1
    finally:
        spark.sql("DROP DATABASE IF EXISTS quoted CASCADE")
