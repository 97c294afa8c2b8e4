"""Readers, writers and the catalog, on lakes written from all derived trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gallery import fixture, stored
from gallery.common import to_six
from gallery.registry import query
from tripmart.operators import catalog, sinks
from tripmart.paths import PARTITION, raw_path, staging_path, under
from tripmart.plans import registry
from tripmart.plans.marts import stack
from tripmart.sources import polygons, raw, weather
from tripmart.sources.lake import read_lake
from tripmart.sources.schemas import FINAL, HOURLY_VARIABLES, RAW, STAGING
from tripmart.workspace import new_workspace


def _by_month(df, amount="total_amount"):
    grouped = df.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"), to_six(F.sum(amount)).alias("amount")
    )
    return grouped


def _by_month_sql(source, amount="total_amount", where="true"):
    return f"""SELECT partition_date, count(*) AS rows, round(sum({amount}), 6) AS amount
        FROM {source} WHERE {where} GROUP BY partition_date"""


# --- readers --------------------------------------------------------------------------------


@query("s01_read_lake", _by_month_sql("stg_yellow"))
def read_whole(spark, sf_dir):
    lake = stored.staged_lake(spark, sf_dir)
    return _by_month(read_lake(spark, lake.location("stg_yellow_taxi"), STAGING["yellow_taxi"]))


def _drifting_lake(spark, sf_dir):
    base = new_workspace(spark)
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi")
    location = under(base, raw_path("yellow_taxi"))
    old = rows.where("partition_date < date '2026-01-01'").withColumns(
        {
            "PULocationID": F.col("PULocationID").cast("int"),
            "passenger_count": F.col("passenger_count").cast("bigint"),
        }
    )
    new = (
        rows.where("partition_date >= date '2026-01-01'")
        .withColumnRenamed("Airport_fee", "airport_fee")
        .drop("congestion_surcharge")
        .withColumn("cbd_congestion_fee", F.lit(0.75))
    )
    sinks.write_lake(old, location, regroup=True)
    new.hint("rebalance", F.col(PARTITION)).write.mode("append").partitionBy(PARTITION).parquet(location)
    return base


@query(
    "s02_union_by_name",
    """SELECT partition_date, count(*) AS rows, round(sum(fare_amount), 6) AS fares,
        count(Airport_fee) AS airport_fees, sum(passenger_count) AS passengers,
        count(CASE WHEN partition_date < DATE '2026-01-01' THEN congestion_surcharge END)
            AS congestion_surcharges,
        count(CASE WHEN partition_date >= DATE '2026-01-01' THEN 1 END) AS cbd_fees,
        sum(PULocationID)::BIGINT AS zones FROM raw_yellow GROUP BY partition_date""",
)
def drifting_months(spark, sf_dir):
    """From 2026 on the files spell a column otherwise, change types, lose one, gain one."""
    base = _drifting_lake(spark, sf_dir)
    united = raw.read_raw_trips(spark, base, "yellow_taxi")
    return united.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        to_six(F.sum("fare_amount")).alias("fares"),
        F.count("Airport_fee").alias("airport_fees"),
        F.sum("passenger_count").alias("passengers"),
        F.count("congestion_surcharge").alias("congestion_surcharges"),
        F.count("cbd_congestion_fee").alias("cbd_fees"),
        F.sum("PULocationID").alias("zones"),
    )


def _nanos_writer(location: str):
    """A task function that writes its rows as Parquet files with 64-bit nanosecond times, by month."""

    def write(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark import TaskContext

        local = location.removeprefix("file:")
        files, root = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(location)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            rows = pa.Table.from_batches([batch])
            for month in rows["partition_date"].unique():
                part = rows.filter(pa.compute.equal(rows["partition_date"], month)).drop_columns(["partition_date"])
                for at, field in enumerate(part.schema):
                    if pa.types.is_timestamp(field.type):
                        part = part.set_column(at, field.name, part.column(at).cast(pa.timestamp("ns")))
                folder = f"{root}/partition_date={month}"
                files.create_dir(folder)
                pq.write_table(part, f"{folder}/part-{task}-{number}.parquet", filesystem=files)
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    return write


def _nanosecond_lake(spark, sf_dir):
    """Months to 2025 hold microseconds, later ones nanoseconds, and one of these holds both."""
    base = new_workspace(spark)
    rows = fixture.raw_trips(spark, sf_dir, "yellow_taxi", joined=fixture.stored_lines(spark, sf_dir))
    location = under(base, raw_path("yellow_taxi"))
    in_both = F.col(PARTITION) == F.lit("2026-02-01").cast("date")
    micros = (F.col(PARTITION) < F.lit("2026-01-01").cast("date")) | (in_both & (F.col("PULocationID") % 2 == 0))
    sinks.write_lake(rows.where(micros), location, regroup=True)
    later = rows.where(~F.coalesce(micros, F.lit(False)))
    written = later.repartition(PARTITION).mapInArrow(_nanos_writer(location), "rows bigint")
    written.agg(F.sum("rows")).collect()
    return base


def _spans(df):
    return df.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_dropoff_datetime").alias("last_dropoff"),
        F.count("tpep_dropoff_datetime").alias("dropoffs"),
        F.sum(F.expr("timestampdiff(SECOND, tpep_pickup_datetime, tpep_dropoff_datetime)")).alias("seconds"),
    )


_SPANS_SQL = """SELECT partition_date, count(*) AS rows, min(tpep_pickup_datetime) AS first_pickup,
    max(tpep_dropoff_datetime) AS last_dropoff, count(tpep_dropoff_datetime) AS dropoffs,
    sum(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime))::BIGINT AS seconds
    FROM raw_yellow GROUP BY partition_date"""


@query("s02_nanosecond_times", _SPANS_SQL)
def nanosecond_times(spark, sf_dir):
    """Files with nanosecond times beside files with microseconds, also within a month."""
    return _spans(raw.read_raw_trips(spark, _nanosecond_lake(spark, sf_dir), "yellow_taxi"))


@query("s03_json_lines", "SELECT * EXCLUDE (t) FROM raw_weather")
def json_lines(spark, sf_dir):
    return raw.read_raw_weather(spark, stored.landed(spark, sf_dir))


@query("s04_csv", "SELECT * FROM raw_zones")
def csv_with_header(spark, sf_dir):
    return raw.read_zone_lookup(spark, stored.landed(spark, sf_dir))


@query("s05_single_file", "SELECT * FROM polygons")
def single_file(spark, sf_dir):
    return raw.read_zone_polygons(spark, stored.landed(spark, sf_dir))


@query("s06_month_scan", "SELECT * FROM stg_hv WHERE partition_date = DATE '2025-03-01'")
def month_scan(spark, sf_dir):
    lake = stored.staged_lake(spark, sf_dir)
    return lake.read("stg_high_volume_fhv", ["2025-03-01"])


@query(
    "s07_upstream_views",
    " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS rows FROM {table}"
        for view, table in (
            ("stg_yellow_taxi", "stg_yellow"),
            ("stg_green_taxi", "stg_green"),
            ("stg_app_rides", "stg_app"),
            ("stg_high_volume_fhv", "stg_hv"),
            ("stg_weather", "stg_weather"),
        )
    ),
)
def upstream_views(spark, sf_dir):
    """Views for what two marts read: through the unstored clean trips to the staging tables."""
    lake = stored.staged_lake(spark, sf_dir)
    names = lake.register_upstream(["trips", "weather_impact"])
    return stack(
        [
            spark.table(n).agg(F.lit(n).alias("view_name"), F.count(F.lit(1)).alias("rows"))
            for n in names
        ]
    )


def _payload(spark, sf_dir):
    """A day's hours as parallel arrays; every seventh day one array is two values short."""
    hours = fixture.raw_weather(spark, sf_dir)
    names = ["time", *HOURLY_VARIABLES]
    # A day has at most 24 hours
    days = hours.groupBy(PARTITION).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("hours"))
    arrays = {n: F.col(f"hours.{n}") for n in names}
    short = F.slice(arrays["weather_code"], F.lit(1), F.greatest(F.size("hours") - 2, F.lit(0)))
    arrays["weather_code"] = F.when(F.dayofmonth(PARTITION) % 7 == 0, short).otherwise(
        arrays["weather_code"]
    )
    return days.select(PARTITION, F.struct(*[a.alias(n) for n, a in arrays.items()]).alias("hourly"))


@query(
    "s08_hourly_unpivot",
    """SELECT * EXCLUDE (t, place, hours) FROM (
        SELECT *, row_number() OVER (PARTITION BY partition_date ORDER BY t) AS place,
            count(*) OVER (PARTITION BY partition_date) AS hours FROM raw_weather)
        WHERE day(partition_date) % 7 <> 0 OR place <= hours - 2""",
)
def hourly_unpivot(spark, sf_dir):
    return weather.hourly_rows(_payload(spark, sf_dir))


@query("s09_rings", "SELECT location_id, geometry_json FROM polygons")
def rings(spark, sf_dir):
    zones = fixture.published_zones(spark, sf_dir)
    return zones.select(
        F.col("LocationID").alias("location_id"),
        polygons.rings_json(F.col("geometry")).alias("geometry_json"),
    )


@query("s10_zone_geometry", "SELECT * FROM polygons")
def zone_geometry(spark, sf_dir):
    return fixture.polygons(spark, sf_dir)


# --- writers --------------------------------------------------------------------------------


@query("w01_full_overwrite", _by_month_sql("stg_yellow", where="partition_date <> DATE '2025-03-01'"))
def full_overwrite(spark, sf_dir):
    """Written twice; a month that left the source is gone."""
    rows = stored.staged_lake(spark, sf_dir).read("stg_yellow_taxi")
    location = under(new_workspace(spark), staging_path("yellow_taxi"))
    sinks.write_lake(rows, location)
    sinks.write_lake(rows.where("partition_date <> date '2025-03-01'"), location)
    return _by_month(read_lake(spark, location, STAGING["yellow_taxi"]))


@query(
    "w02_month_overwrite",
    _by_month_sql(
        "stg_yellow", where="partition_date <> DATE '2025-03-01' OR passenger_count IS NOT NULL"
    ),
)
def month_overwrite(spark, sf_dir):
    """March is replaced; April, asked for but now empty, stays as it was."""
    rows = stored.staged_lake(spark, sf_dir).read("stg_yellow_taxi")
    location = under(new_workspace(spark), staging_path("yellow_taxi"))
    sinks.write_lake(rows, location)
    changed = rows.where("passenger_count is not null and partition_date <> date '2025-04-01'")
    sinks.write_lake(changed, location, months=["2025-03-01", "2025-04-01"])
    return _by_month(read_lake(spark, location, STAGING["yellow_taxi"]))


@query("w03_single_file", "SELECT * FROM weather_daily")
def single_file_written(spark, sf_dir):
    location = under(new_workspace(spark), "final/weather_daily")
    days = stored.built_lake(spark, sf_dir).read("weather_daily")
    sinks.replace_file(days.limit(0), location)
    sinks.replace_file(days, location)
    return read_lake(spark, location, FINAL["weather_daily"])


@query("w04_view", _by_month_sql("stg_green"))
def view(spark, sf_dir):
    lake = stored.staged_lake(spark, sf_dir)
    sinks.publish_view(
        spark, lake.location("stg_green_taxi"), "stored_green", STAGING["green_taxi"]
    )
    return _by_month(spark.table("stored_green"))


@query(
    "w05_partition_argument",
    _by_month_sql("stg_yellow", where="partition_date IN (DATE '2025-11-01', DATE '2025-12-01')"),
)
def partition_argument(spark, sf_dir):
    rows = stored.staged_lake(spark, sf_dir).read("stg_yellow_taxi")
    location = under(new_workspace(spark), staging_path("yellow_taxi"))
    sinks.write_lake(rows, location, months=" 2025-11-01, ,2025-12-01 ")
    return _by_month(read_lake(spark, location, STAGING["yellow_taxi"]))


@query(
    "w06_sandbox",
    """SELECT 'lake' AS place, partition_date, count(*) AS trips FROM stg_app GROUP BY ALL
        UNION ALL SELECT 'sandbox', partition_date, count(*) FROM stg_app
        WHERE partition_date = DATE '2025-03-01' GROUP BY ALL""",
)
def redirected(spark, sf_dir):
    """A month rebuilt in a sandbox from the same raw files leaves the lake alone."""
    lake = stored.staged_lake(spark, sf_dir)
    other = stored.sandbox(spark, sf_dir, faultless=False)
    other.build("stg_taxi_zone_lookup")
    other.build("stg_app_rides", ["2025-03-01"])
    return stack(
        [
            where.read("stg_app_rides")
            .groupBy(F.lit(place).alias("place"), PARTITION)
            .agg(F.count(F.lit(1)).alias("trips"))
            for place, where in (("lake", lake), ("sandbox", other))
        ]
    )


@query(
    "w07_paths",
    """SELECT 'raw/yellow_taxi/partition_date=' || partition_date AS folder, count(*) AS rows
        FROM raw_yellow GROUP BY partition_date""",
)
def paths(spark, sf_dir):
    """The folder each landed record lies in."""
    base = stored.landed(spark, sf_dir)
    rows = read_lake(spark, under(base, raw_path("yellow_taxi")))
    folder = F.regexp_extract("_metadata.file_path", r"(raw/yellow_taxi/partition_date=[^/]+)/", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("rows"))


# --- catalog --------------------------------------------------------------------------------


def _database():
    return f"gallery_{uuid.uuid4().hex[:12]}"


@query("w08_create_table", _by_month_sql("stg_yellow"))
def create_table(spark, sf_dir):
    lake, database = stored.staged_lake(spark, sf_dir), _database()
    catalog.create_external_table(spark, database, "yellow_taxi", lake.location("stg_yellow_taxi"))
    catalog.sync_partitions(spark, database, "yellow_taxi")
    return _by_month(spark.table(f"{database}.yellow_taxi"))


@query("w09_sync_partitions", _by_month_sql("stg_yellow", where="partition_date >= DATE '2025-04-01'"))
def sync(spark, sf_dir):
    """Registered with early months, then the folder changes to late months only."""
    rows = stored.staged_lake(spark, sf_dir).read("stg_yellow_taxi")
    location, database = under(new_workspace(spark), staging_path("yellow_taxi")), _database()
    sinks.write_lake(rows.where("partition_date < date '2025-06-01'"), location)
    catalog.repair_table(spark, database, "yellow_taxi", location)
    sinks.write_lake(rows.where("partition_date >= date '2025-04-01'"), location)
    catalog.repair_table(spark, database, "yellow_taxi", location)
    return _by_month(spark.table(f"{database}.yellow_taxi"))


@query(
    "w10_recreate",
    """SELECT partition_date, count(*) AS rows, round(sum(total_amount), 6) AS amount,
        count(total_amount) AS added FROM stg_yellow GROUP BY partition_date""",
)
def recreate(spark, sf_dir):
    """Registered again after the files gained a column."""
    rows = stored.staged_lake(spark, sf_dir).read("stg_yellow_taxi")
    location, database = under(new_workspace(spark), staging_path("yellow_taxi")), _database()
    sinks.write_lake(rows, location)
    catalog.recreate_tables(spark, database, {"yellow_taxi": location})
    sinks.write_lake(rows.withColumn("Added", F.col("total_amount")), location)
    catalog.recreate_tables(spark, database, {"yellow_taxi": location})
    table = spark.table(f"{database}.yellow_taxi")
    return table.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        to_six(F.sum("total_amount")).alias("amount"),
        F.count("added").alias("added"),
    )


_NUMBERS = (
    "VendorID, passenger_count, trip_distance, RatecodeID, PULocationID, DOLocationID, payment_type, fare_amount, extra, "
    "mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, airport_fee"
).split(", ")
_SUMS_SQL = ", ".join(f"round(sum({c}), 6)::DOUBLE AS sum_{c.lower()}" for c in _NUMBERS)


@query(
    "w10_drifting_months",
    f"""SELECT partition_date, count(*) AS rows, {_SUMS_SQL},
        count(CASE WHEN partition_date < DATE '2026-01-01' THEN congestion_surcharge END) AS surcharges,
        count(CASE WHEN partition_date >= DATE '2026-01-01' THEN 1 END) AS cbd_fees,
        min(tpep_pickup_datetime) AS first_pickup, count(store_and_fwd_flag) AS flags FROM raw_yellow GROUP BY partition_date""",
)
def drifting_table(spark, sf_dir):
    """A lake whose months drift, under one name: registered with early months, then brought in step."""
    base, database = _drifting_lake(spark, sf_dir), _database()
    location = under(base, raw_path("yellow_taxi"))
    catalog.repair_layouts(spark, database, "yellow_taxi", location, RAW["yellow_taxi"])
    rows = spark.table(f"{database}.yellow_taxi")
    result = rows.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        *[to_six(F.sum(c)).cast("double").alias(f"sum_{c.lower()}") for c in _NUMBERS],
        F.count("congestion_surcharge").alias("surcharges"),
        F.count("cbd_congestion_fee").alias("cbd_fees"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.count("store_and_fwd_flag").alias("flags"),
    )
    kept = new_workspace(spark)
    result.write.parquet(kept)  # so that the database can go
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(result.schema).parquet(kept)


@query("w10_nanosecond_table", _SPANS_SQL)
def nanosecond_table(spark, sf_dir):
    """Registered while a month is missing, then in step with the files, by SQL over the view."""
    location, database = under(_nanosecond_lake(spark, sf_dir), raw_path("yellow_taxi")), _database()
    early = new_workspace(spark)
    sinks.write_lake(read_lake(spark, location, f"{RAW['yellow_taxi']}, {PARTITION} date", ["2025-01-01"]), early)
    catalog.repair_layouts(spark, database, "yellow_taxi", early, RAW["yellow_taxi"])
    catalog.repair_layouts(spark, database, "yellow_taxi", location, RAW["yellow_taxi"])
    result = _spans(spark.table(f"{database}.yellow_taxi"))
    kept = new_workspace(spark)
    result.write.parquet(kept)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(result.schema).parquet(kept)


_LAYER_SQL = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS rows FROM {source}"
    for layer, table, source in (
        ("raw", "yellow_taxi", "raw_yellow"),
        ("raw", "green_taxi", "raw_green"),
        ("raw", "app_rides", "raw_app"),
        ("raw", "high_volume_fhv", "raw_hv"),
        ("raw", "weather", "raw_weather"),
        ("staging", "yellow_taxi", "stg_yellow"),
        ("staging", "green_taxi", "stg_green"),
        ("staging", "app_rides", "stg_app"),
        ("staging", "high_volume_fhv", "stg_hv"),
        ("staging", "weather", "stg_weather"),
        ("staging", "taxi_zones_geo", "polygons"),
        ("final", "trips", "trips"),
        ("final", "revenue", "revenue"),
        ("final", "weather_impact", "weather_impact"),
        ("final", "trips_hourly", "trips_hourly"),
        ("final", "weather_daily", "weather_daily"),
        ("final", "zones_geo", "zones_geo"),
    )
)


@query("w11_layer_tables", _LAYER_SQL)
def layer_tables(spark, sf_dir):
    """Every table the registry lists, registered and counted."""
    lake = stored.built_lake(spark, sf_dir)
    counts = []
    for layer, tables in registry.layer_tables().items():
        database = _database()
        for table, path in tables.items():
            in_source = layer == "raw" or table == "taxi_zones_geo"
            base = lake.source_base if in_source else lake.model_base
            how = {}
            if layer == "raw":
                how["schema"] = lake.read_raw(table).schema
                how["file_format"] = "json" if table == "weather" else "parquet"
            catalog.recreate_tables(spark, database, {table: under(base, path)}, **how)
            counts.append(
                spark.table(f"{database}.{table}").agg(
                    F.lit(layer).alias("layer"),
                    F.lit(table).alias("table_name"),
                    F.count(F.lit(1)).alias("rows"),
                )
            )
    return stack(counts)
