"""The dashboard: datasets over the marts, their metrics, the charts and their filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.clock import monday_first
from tripmart.functions.codes import SERVICE_LABELS, translate
from tripmart.functions.labels import (
    DRY_BELOW_MM,
    hour_label,
    numbered_weekday,
    rain_band,
    weekday_label,
)
from tripmart.paths import PARTITION

# The map's break points, the speed chart's period, the charts' row limits.
BREAK_POINTS = (0, 6_000_000, 13_000_000, 22_000_000, 45_000_000, 100_000_000, 470_000_000)
SPEED_PERIOD = (datetime(2025, 1, 1), datetime(2025, 8, 1))
TOP_ZONES = 10


def ratio(top: Column, bottom: Column) -> Column:
    """NULL where there is nothing to divide by."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


# --- datasets -------------------------------------------------------------------------------


def service_label() -> Column:
    return translate("taxi_type", SERVICE_LABELS)


def hourly_columns() -> dict[str, Column]:
    hour = F.col("pickup_hour")
    return {
        "weekday_label": weekday_label(hour),
        "taxi_type_label": service_label(),
        "hour_label": hour_label(hour),
    }


def trip_columns() -> dict[str, Column]:
    at = F.col("pickup_datetime")
    return {
        "weekday_label": weekday_label(at),
        "weekday": numbered_weekday(at),
        "taxi_type_label": service_label(),
        "hour_label": hour_label(at),
        "day_of_week": monday_first(at),
        "hour_of_day": F.hour(at),
    }


def revenue_columns() -> dict[str, Column]:
    return {"taxi_type_label": service_label()}


def hourly_metrics() -> dict[str, Column]:
    revenue, miles = F.sum("revenue"), F.sum("distance_miles")
    hours = F.sum("duration_minutes_with_distance") / F.lit(60.0)
    return {
        "count": F.sum("trips"),
        "total_fare": revenue,
        "avg_fare": ratio(revenue, F.sum("fare_trips")),
        "revenue_per_mile": ratio(revenue, miles),
        "avg_speed_mph": ratio(miles, hours),
    }


def trip_metrics() -> dict[str, Column]:
    revenue = F.sum("fare_amount")
    return {
        "count": F.count(F.lit(1)),
        "total_fare": revenue,
        "avg_fare": F.avg("fare_amount"),
        "revenue_per_mile": ratio(revenue, F.sum("trip_distance_miles")),
    }


def revenue_metrics() -> dict[str, Column]:
    return {
        "avg_fare": F.avg("fare_amount"),
        "total_revenue": F.sum("total_amount"),
        "count": F.count(F.lit(1)),
    }


def row_metrics() -> dict[str, Column]:
    return {"count": F.count(F.lit(1))}


def rain_intensity_daily(days: DataFrame) -> DataFrame:
    """Each day's rain band, and its trips against the mean dry day of the same weekday.

    The window splits one row per day into seven weekdays.
    """
    same_weekday = Window.partitionBy(monday_first(F.col("date")))
    dry_trips = F.when(F.col("total_precipitation_mm") < F.lit(DRY_BELOW_MM), F.col("trips"))
    usual = F.avg(dry_trips).over(same_weekday)
    return days.select(
        "date",
        "day_type",
        "total_precipitation_mm",
        "trips",
        rain_band(F.col("total_precipitation_mm")).alias("rain_intensity"),
        # A weekday whose dry days saw no trips cannot occur: a day without trips has no row
        (F.col("trips") / usual - F.lit(1.0)).alias("vs_dry_same_weekday"),
    )


@dataclass(frozen=True)
class Dataset:
    """What charts can use of a mart. `prepare` turns the mart into the dataset's rows."""

    mart: str
    time_column: str | None
    columns: Callable[[], dict[str, Column]]
    metrics: Callable[[], dict[str, Column]]
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df


DATASETS = {
    "trips_hourly": Dataset("trips_hourly", "pickup_hour", hourly_columns, hourly_metrics),
    "trips": Dataset("trips", "pickup_datetime", trip_columns, trip_metrics),
    "revenue": Dataset("revenue", "pickup_datetime", revenue_columns, revenue_metrics),
    "zones_geo": Dataset("zones_geo", None, dict, row_metrics),
    "rain_intensity_daily": Dataset(
        "weather_daily", "date", dict, row_metrics, rain_intensity_daily
    ),
}


# --- filters --------------------------------------------------------------------------------

Period = tuple[date | datetime | None, date | datetime | None]


@dataclass(frozen=True)
class Filters:
    """What the viewer chose. `clicked` holds values picked in another chart."""

    period: Period | None = None
    services: tuple[str, ...] = ()
    boroughs: tuple[str, ...] = ()
    clicked: Mapping[str, object] = field(default_factory=dict)


NO_FILTER = Filters()


def in_period(df: DataFrame, time_column: str, period: Period | None) -> DataFrame:
    """From the first moment up to, not including, the second; either may be open.

    A monthly table is also cut by month, which the scan prunes. That drops nothing: a clean trip
    lies within the month after its partition date.
    """
    if period is None:
        return df
    first, end = period
    monthly = PARTITION in df.columns
    if first is not None:
        df = df.where(F.col(time_column) >= F.lit(first).cast("timestamp_ntz"))
        if monthly:
            df = df.where(F.col(PARTITION) > F.add_months(F.lit(first).cast("date"), -1))
    if end is not None:
        df = df.where(F.col(time_column) < F.lit(end).cast("timestamp_ntz"))
        if monthly:
            df = df.where(F.col(PARTITION) <= F.lit(end).cast("date"))
    return df


def apply_filters(df: DataFrame, time_column: str | None, filters: Filters) -> DataFrame:
    """Each filter applies where its column exists; charts without it stay as they are."""
    if time_column:
        df = in_period(df, time_column, filters.period)
    chosen = {"taxi_type_label": filters.services, "pickup_borough": filters.boroughs}
    for column, values in chosen.items():
        if values and column in df.columns:
            df = df.where(F.col(column).isin(list(values)))
    for column, value in filters.clicked.items():
        if column in df.columns:
            df = df.where(F.col(column) == F.lit(value))
    return df


# --- charts ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Chart:
    """A grouped query over a dataset. `finish` orders, limits or adds to the grouped rows."""

    dataset: str
    measures: Mapping[str, Callable[[dict[str, Column]], Column]]
    by: tuple[str, ...] = ()
    where: Callable[[], Column] | None = None
    period: Period | None = None
    finish: Callable[[DataFrame], DataFrame] = lambda df: df


def metric(name: str) -> Callable[[dict[str, Column]], Column]:
    return lambda metrics: metrics[name]


def _ordered(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.orderBy(*columns)


def top_zones(df: DataFrame, limit: int = TOP_ZONES) -> DataFrame:
    """Most revenue first; the name settles ties. Sort and limit become one top-k step."""
    return df.orderBy(F.desc_nulls_last("revenue"), "pickup_zone").limit(limit)


def share_of_bar(df: DataFrame) -> DataFrame:
    """Each service's part of its bar. The window sees one row per service."""
    bar = Window.partitionBy("bar")
    rows = df.select(F.lit("All trips").alias("bar"), "*")
    rows = rows.withColumn("share", ratio(F.col("trips"), F.sum("trips").over(bar)))
    return rows.orderBy(F.desc("trips"), "taxi_type_label")


def colour_bucket(value: Column, points: tuple = BREAK_POINTS) -> Column:
    """Number of the range a value lies in, from 1; the top point belongs to the last range."""
    bucket = F.when(value == F.lit(points[-1]), F.lit(len(points) - 1))
    for number, (low, high) in enumerate(zip(points, points[1:]), start=1):
        bucket = bucket.when((value >= F.lit(low)) & (value < F.lit(high)), F.lit(number))
    return bucket


def map_buckets(points: tuple = BREAK_POINTS) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("bucket", colour_bucket(F.col("total_revenue"), points))


CHARTS: dict[str, Chart] = {
    "total_trips": Chart("trips_hourly", {"trips": metric("count")}),
    "revenue": Chart("trips_hourly", {"revenue": metric("total_fare")}),
    "average_fare": Chart("trips_hourly", {"avg_fare": metric("avg_fare")}),
    "revenue_per_mile": Chart("trips_hourly", {"revenue_per_mile": metric("revenue_per_mile")}),
    "speed_by_hour": Chart(
        "trips_hourly",
        {"avg_speed_mph": metric("avg_speed_mph")},
        by=("hour_label",),
        period=SPEED_PERIOD,
        finish=_ordered("hour_label"),
    ),
    "hour_by_weekday": Chart(
        "trips_hourly",
        {"trips": metric("count")},
        by=("hour_label", "weekday_label"),
        finish=_ordered("hour_label", "weekday_label"),
    ),
    "top_zones": Chart(
        "trips_hourly", {"revenue": metric("total_fare")}, by=("pickup_zone",), finish=top_zones
    ),
    "service_share": Chart(
        "trips_hourly", {"trips": metric("count")}, by=("taxi_type_label",), finish=share_of_bar
    ),
    "zone_map": Chart(
        "zones_geo",
        {"total_revenue": lambda _: F.sum("total_revenue")},
        by=("geometry_json", "zone", "borough"),
        where=lambda: F.col("geometry_json").isNotNull(),
        finish=map_buckets(),
    ),
    "rain_effect": Chart(
        "rain_intensity_daily",
        {"trips_vs_dry_day": lambda _: F.avg("vs_dry_same_weekday")},
        by=("rain_intensity",),
        where=lambda: F.col("total_precipitation_mm") >= F.lit(DRY_BELOW_MM),
        finish=_ordered("rain_intensity"),
    ),
}

# Charts whose clicked value filters the others, and the column they emit
EMITTERS = {
    "speed_by_hour": "hour_label",
    "service_share": "taxi_type_label",
    "top_zones": "pickup_zone",
    "zone_map": "zone",
    "rain_effect": "rain_intensity",
}


def dataset(name: str, marts: Mapping[str, DataFrame]) -> DataFrame:
    """A mart with its calculated columns."""
    spec = DATASETS[name]
    df = spec.prepare(marts[spec.mart])
    return df.withColumns(spec.columns()) if spec.columns() else df


def run_chart(
    chart: Chart, marts: Mapping[str, DataFrame], filters: Filters = NO_FILTER
) -> DataFrame:
    spec = DATASETS[chart.dataset]
    df = dataset(chart.dataset, marts)
    if chart.where:
        df = df.where(chart.where())
    # A chart's own period holds unless the viewer chose one
    if chart.period and filters.period is None:
        filters = replace(filters, period=chart.period)
    df = apply_filters(df, spec.time_column, filters)
    metrics = spec.metrics()
    measures = [pick(metrics).alias(name) for name, pick in chart.measures.items()]
    return chart.finish(df.groupBy(*chart.by).agg(*measures))


def chart(name: str, marts: Mapping[str, DataFrame], filters: Filters = NO_FILTER) -> DataFrame:
    return run_chart(CHARTS[name], marts, filters)


def cross_filtered(
    name: str,
    marts: Mapping[str, DataFrame],
    clicks: Mapping[str, object],
    filters: Filters = NO_FILTER,
) -> DataFrame:
    """A chart under values clicked in others (emitter -> value); its own click is left out."""
    clicked = {EMITTERS[e]: value for e, value in clicks.items() if e != name}
    return chart(name, marts, replace(filters, clicked={**filters.clicked, **clicked}))


def filter_values(name: str, column: str, marts: Mapping[str, DataFrame]) -> DataFrame:
    """The values a select filter offers."""
    return dataset(name, marts).select(column).distinct().orderBy(column)


def service_values(marts: Mapping[str, DataFrame]) -> DataFrame:
    return filter_values("trips", "taxi_type_label", marts)


def borough_values(marts: Mapping[str, DataFrame]) -> DataFrame:
    return filter_values("revenue", "pickup_borough", marts)


def metric_table(
    name: str, marts: Mapping[str, DataFrame], by: Iterable[str] = (), filters: Filters = NO_FILTER
) -> DataFrame:
    """All metrics of a dataset, grouped as asked."""
    spec = DATASETS[name]
    df = apply_filters(dataset(name, marts), spec.time_column, filters)
    return df.groupBy(*by).agg(*[m.alias(n) for n, m in spec.metrics().items()])
