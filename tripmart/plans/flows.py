"""Builds of whole layers: plan, validate, build, test, register."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.catalog import recreate_tables, repair_layouts, repair_table
from tripmart.operators.checks import LOOKBACK, ChecksFailed, gate, run_checks, trips_by_partition, unreconciled, unreconciled_partitions
from tripmart.operators.sinks import replace_file
from tripmart.paths import FINAL, PARTITION, RAW, STAGING, parse_months, raw_path, staging_path
from tripmart.plans import suites
from tripmart.plans.registry import (
    MODELS,
    MONTHLY_MARTS,
    SMALL_MARTS,
    STAGED_SERVICES,
    SUMMARY_MARTS,
    TRIP_MARTS,
    Lake,
    layer_tables,
)
from tripmart.plans.staging import SERVICES
from tripmart.plans.staleness import plan_months
from tripmart.sources import schemas
from tripmart.sources.lake import footer_counts, list_files, list_partitions, path_exists
from tripmart.sources.polygons import zone_geometry

POLYGONS = staging_path("reference/taxi_zones_geo")


def check_raw(lake: Lake, table: str, months: list[str] | None = None) -> list:
    """All tests of a raw table; with months, of these months only.

    Volumes are compared with those of the months just before, which come from the footers of their
    files: no row of these months is read.
    """
    checks, months = suites.RAW[table], parse_months(months)
    needs_lookup = any(c.kind == "relationships" for c in checks)
    lookups = {suites.LOOKUP: lake.read_raw(suites.LOOKUP)} if needs_lookup else {}
    earlier = None
    if months:
        location = lake.source_location(raw_path(table))
        landed = list_partitions(lake.spark, location)
        back = max(c.arguments.get("lookback", LOOKBACK) for c in checks if c.kind == "partition_volume")
        places = [at for at, month in enumerate(landed) if month in months]
        before = sorted({month for at in places for month in landed[max(0, at - back) : at]} - set(months))
        if before:
            one_column = f"{schemas.RAW[table].partition(',')[0]}, {PARTITION} date"
            counted = footer_counts(lake.spark, location, one_column, before)
            earlier = counted.withColumnRenamed(PARTITION, "partition_value")
    tested = [date.fromisoformat(month) for month in months]
    return gate(run_checks(lake.read_raw(table, months), checks, lookups, tested, earlier), f"raw {table}")


def check_model(
    lake: Lake, name: str, months: list[str] | None = None, rows: DataFrame | None = None
) -> list:
    """All tests of a stored table; with months, of these months only; or of `rows` in its place.

    Tests of single rows need no more than the months just built, since the others passed when
    they were.
    """
    model = MODELS[name]
    suite = {STAGING: suites.STAGING, FINAL: suites.final(lake.limits)}[model.layer][model.table]
    chosen = months if model.partition_by else None
    return gate(run_checks(lake.read(name, chosen) if rows is None else rows, suite), name)


def build_and_check(lake: Lake, name: str, months: list[str] | None = None, test_built_only: bool = True) -> None:
    """Write a model beside the live table and test it there. Failing rows never reach a reader."""
    lake.build(name, months, pending=True)
    check_model(lake, name, rows=lake.read_pending(name, months, test_built_only))


def build_staging(
    lake: Lake,
    service: str,
    full_refresh: bool = False,
    database: str | None = None,
    test_built_only: bool = True,
) -> list[str]:
    """One trip service: the months it rebuilt, nothing if all are fresh.

    Months are built aside, tested and then published, so a failing test leaves the table as it was.
    The tests of monthly tables look at single rows, at rows of one month or at a month's volume, so
    those of earlier months passed when these were built; without `test_built_only` all are read again.
    """
    name = f"stg_{service}"
    months = plan_months(
        lake.spark,
        [lake.source_location(raw_path(service))],
        [lake.location(name)],
        full_refresh,
    )
    if not months:
        return []
    check_raw(lake, service, months if test_built_only else None)
    build_and_check(lake, name, months, test_built_only)
    lake.publish(name, months)
    if database:
        repair_table(lake.spark, database, service, lake.location(name))
    return months


def unreconciled_months(lake: Lake, months: list[str], **pending: DataFrame) -> DataFrame:
    """Marts and months that do not add up to the trips of these months; `pending` are marts not published yet.

    Trips are counted by the footers of their files. The weather mart has no months: its monthly
    summary is compared in its place, and the mart as a whole (no partition_value) with the summary.
    """
    model, tested = MODELS["trips"], [date.fromisoformat(month) for month in parse_months(months)]
    held = list_partitions(lake.spark, lake.location("trips"))
    kept = [month for month in parse_months(months) if month in held]
    if kept:
        counted = footer_counts(lake.spark, lake.location("trips"), model.schema, kept)
    else:
        counted = lake.spark.createDataFrame([], f"{PARTITION} date, row_count bigint")
    trips = counted.select(F.col(PARTITION).alias("partition_value"), F.col("row_count").alias("trips"))
    measure = F.sum("trips")

    def of_months(mart: DataFrame) -> DataFrame:
        return trips_by_partition(mart.where(F.col(PARTITION).isin(tested)), PARTITION, measure)

    def whole(mart: DataFrame) -> DataFrame:
        return mart.agg(F.lit(None).cast("date").alias("partition_value"), measure.cast("bigint").alias("trips"))

    def mart(name: str) -> DataFrame:
        return pending[name] if name in pending else lake.read(name)

    days = lake.summary("weather_impact", MODELS["weather_daily"].summaries["weather_impact"])
    by_month = unreconciled_partitions(trips, trips_hourly=of_months(mart("trips_hourly")), weather_daily=of_months(days))
    return by_month.unionByName(unreconciled_partitions(whole(days), weather_daily=whole(mart("weather_daily"))))


def reconcile(lake: Lake, months: list[str] | None = None, **pending: DataFrame) -> None:
    """Stop if a mart does not add up to the trips, of these months or of all by their totals."""
    if months:
        found = unreconciled_months(lake, months, **pending)
    else:
        marts = {n: pending[n] if n in pending else lake.read(n) for n in ("trips_hourly", "weather_daily")}
        found = unreconciled(lake.read("trips"), **marts)
    marts = sorted({r["mart"] for r in found.select("mart").distinct().collect()})
    if marts:
        raise ChecksFailed("marts do not add up to trips: " + ", ".join(marts))


def build_final(
    lake: Lake,
    full_refresh: bool = False,
    database: str | None = None,
    test_built_only: bool = True,
) -> list[str]:
    """Stale months of the monthly marts, then the small marts whole, from summaries by month.

    Either wave is built aside, tested and then published. The second one reads the first as
    published, and must add up to it. Weather is not among the planned sources: a late correction
    reaches a month when that month is rebuilt for another reason, or by a full refresh.
    """
    months = plan_months(
        lake.spark,
        [lake.location(s) for s in STAGED_SERVICES],
        [lake.location(m) for m in MONTHLY_MARTS],
        full_refresh,
    )
    if not months:
        return []
    for wave in (TRIP_MARTS, SUMMARY_MARTS):
        lake.side_by_side(lambda name: build_and_check(lake, name, months, test_built_only), wave)
        if wave is SUMMARY_MARTS:
            pending = {n: lake.read_pending(n, months, test_built_only) for n in ("trips_hourly", "weather_daily")}
            reconcile(lake, months if test_built_only else None, **pending)
        for name in wave:
            lake.publish(name, months)
    if database:
        recreate_tables(
            lake.spark, database, {m: lake.location(m) for m in (*MONTHLY_MARTS, *SMALL_MARTS)}
        )
    return months


def build_weather(lake: Lake, database: str | None = None) -> None:
    """Weather is small: always rebuilt whole."""
    build_and_check(lake, "stg_weather")
    lake.publish("stg_weather")
    if database:
        repair_table(lake.spark, database, "weather", lake.location("stg_weather"))


def build_zones(
    lake: Lake, published: DataFrame | None = None, database: str | None = None
) -> bool:
    """The zone lookup, and the polygons unless they are staged; tells if polygons were written."""
    check_raw(lake, "taxi_zone_lookup")
    build_and_check(lake, "stg_taxi_zone_lookup")
    lake.publish("stg_taxi_zone_lookup")
    lake.forget_lookup()
    location = lake.source_location(POLYGONS)
    written = published is not None and not path_exists(lake.spark, location)
    if written:
        replace_file(zone_geometry(published), location)
    if database and path_exists(lake.spark, location):
        recreate_tables(lake.spark, database, {"taxi_zones_geo": location})
    return written


def register_raw(lake: Lake, database: str) -> None:
    """Raw tables with the columns all their months have between them; trips as views, since their types drift."""
    for table, path in layer_tables()[RAW].items():
        location = lake.source_location(path)
        if table in schemas.RAW:
            repair_layouts(lake.spark, database, table, location, schemas.RAW[table])
        else:
            how = {"file_format": "json", "schema": lake.read_raw(table).schema}
            recreate_tables(lake.spark, database, {table: location}, **how)


def months_between(first: date, last: date) -> list[str]:
    """First days of the months from `first` to `last`, which counts whole."""
    months = []
    year, month = first.year, first.month
    while (year, month) <= (last.year, last.month):
        months.append(date(year, month, 1).isoformat())
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return months


def missing_days(lake: Lake, first: date, last: date) -> DataFrame:
    """Days from the first of `first`'s month to the end of `last`'s month with no weather file."""
    days = lake.spark.range(1).select(
        F.explode(
            F.sequence(
                F.trunc(F.lit(first), "month"), F.last_day(F.lit(last)), F.expr("INTERVAL 1 DAY")
            )
        ).alias(PARTITION)
    )
    landed = list_files(lake.spark, lake.source_location(raw_path("weather"))).select(PARTITION)
    return days.join(landed.distinct(), PARTITION, "left_anti")


def load_history(
    lake: Lake,
    first: date,
    last: date,
    published_zones: DataFrame | None = None,
    databases: dict[str, str] | None = None,
) -> dict[str, list[str]]:
    """Everything from landed files, in the order the tables need each other.

    Returns the months each service and the final layer built. Trip months of the range that are
    not published yet are passed over and returned under `absent`, as service and month; a range
    whose weather days have not all landed is refused. Stale months outside the range are built too.
    """
    names = databases or {}
    gaps = [r[0].isoformat() for r in missing_days(lake, first, last).orderBy(PARTITION).take(5)]
    if gaps:
        raise FileNotFoundError(f"no weather files for {', '.join(gaps)} ...")
    absent = []
    for service in SERVICES:
        landed = list_partitions(lake.spark, lake.source_location(raw_path(service)))
        absent += [f"{service} {m}" for m in months_between(first, last) if m not in landed]
    build_zones(lake, published_zones, names.get(STAGING))
    build_weather(lake, names.get(STAGING))
    built = lake.side_by_side(
        lambda s: build_staging(lake, s, database=names.get(STAGING)), SERVICES
    )
    built["final"] = build_final(lake, database=names.get(FINAL))
    built["absent"] = absent
    if RAW in names:
        register_raw(lake, names[RAW])
    return built
