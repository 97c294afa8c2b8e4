"""Every table: where it lies, what it is made of, how it is built."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.dimensions import broadcast_if_small
from tripmart.operators.quality import USUAL, Limits
from tripmart.operators.sinks import publish, write_lake
from tripmart.paths import (
    FINAL,
    PARTITION,
    RAW,
    STAGING,
    final_path,
    parse_months,
    pending_path,
    raw_path,
    staging_path,
    summary_path,
    under,
)
from tripmart.plans import marts, staging
from tripmart.plans.staleness import plan_months
from tripmart.sources import raw, schemas
from tripmart.sources.lake import in_months, list_partitions, path_exists, read_lake

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Summary:
    """Rows per month of a stored table, kept beside it, from which a small mart is folded.

    Only months written since are summarised again, so the mart never rescans the history.
    """

    name: str
    build: Callable[[DataFrame], DataFrame]

    @property
    def path(self) -> str:
        return summary_path(self.name)

    @property
    def schema(self) -> str:
        return schemas.SUMMARIES[self.name]


@dataclass(frozen=True)
class Model:
    """A table and its recipe. One without a path is never stored but built where it is used."""

    name: str
    table: str
    layer: str
    depends_on: tuple[str, ...]
    build: Callable[[Inputs, Limits], DataFrame]
    path: str | None = None
    schema: str | None = None
    partition_by: str | None = None
    regroup: bool = False
    summaries: Mapping[str, Summary] = field(default_factory=dict)  # what is read in an input's place

    @property
    def stored(self) -> bool:
        return self.path is not None


def _staged_trips(service: str) -> Model:
    source, lookup = f"raw.{service}", "stg_taxi_zone_lookup"
    return Model(
        name=f"stg_{service}",
        table=service,
        layer=STAGING,
        depends_on=(source, lookup),
        build=lambda inputs, _: staging.STAGERS[service](inputs[source], inputs[lookup]),
        path=staging_path(service),
        schema=schemas.STAGING[service],
        partition_by=PARTITION,
    )


def _clean_trips(service: str) -> Model:
    source = f"stg_{service}"
    return Model(
        name=f"int_{service}_clean",
        table=service,
        layer="intermediate",
        depends_on=(source,),
        build=lambda inputs, limits: marts.clean(inputs[source], service, limits),
    )


def _mart(
    name: str,
    depends_on: tuple[str, ...],
    build: Callable[[Inputs, Limits], DataFrame],
    monthly: bool,
    regroup: bool = False,
    summaries: Mapping[str, Summary] = {},
) -> Model:
    return Model(
        name=name,
        table=name,
        layer=FINAL,
        depends_on=depends_on,
        build=build,
        path=final_path(name),
        schema=schemas.FINAL[name],
        partition_by=PARTITION if monthly else None,
        regroup=regroup,
        summaries=summaries,
    )


def _by_service(inputs: Inputs, services: tuple[str, ...]) -> dict[str, DataFrame]:
    return {s: inputs[f"int_{s}_clean"] for s in services}


_ALL = staging.SERVICES
_PRICED = (*marts.METERED, "high_volume_fhv")
_CLEAN = tuple(f"int_{s}_clean" for s in _ALL)

_MODELS = [
    *[_staged_trips(s) for s in _ALL],
    Model(
        name="stg_weather",
        table="weather",
        layer=STAGING,
        depends_on=("raw.weather",),
        build=lambda inputs, _: staging.stage_weather(inputs["raw.weather"]),
        path=staging_path("weather"),
        schema=schemas.STAGING["weather"],
        partition_by=PARTITION,
        # One small file per day is read; a task holds many days
        regroup=True,
    ),
    Model(
        name="stg_taxi_zone_lookup",
        table="taxi_zone_lookup",
        layer=STAGING,
        depends_on=("raw.taxi_zone_lookup",),
        build=lambda inputs, _: staging.stage_zone_lookup(inputs["raw.taxi_zone_lookup"]),
        path=staging_path("reference/taxi_zone_lookup"),
        schema=schemas.STAGING["taxi_zone_lookup"],
    ),
    *[_clean_trips(s) for s in _ALL],
    _mart("trips", _CLEAN, lambda i, limits: marts.trips(_by_service(i, _ALL), limits), monthly=True),
    _mart(
        "revenue",
        tuple(f"int_{s}_clean" for s in _PRICED),
        lambda i, limits: marts.revenue(_by_service(i, _PRICED), limits),
        monthly=True,
    ),
    _mart(
        "weather_impact",
        (*_CLEAN, "stg_weather"),
        lambda i, limits: marts.weather_impact(_by_service(i, _ALL), i["stg_weather"], limits),
        monthly=True,
    ),
    _mart(
        "trips_hourly",
        ("trips",),
        lambda i, _: marts.trips_hourly(i["trips"]),
        monthly=True,
        regroup=True,
    ),
    _mart(
        "weather_daily",
        ("weather_impact",),
        lambda i, _: marts.fold_days(i["weather_impact"]),
        monthly=False,
        summaries={"weather_impact": Summary("monthly_days", marts.monthly_days)},
    ),
    _mart(
        "zones_geo",
        ("revenue", "reference.taxi_zones_geo"),
        lambda i, _: marts.zones_with_totals(i["reference.taxi_zones_geo"], marts.fold_zone_revenue(i["revenue"])),
        monthly=False,
        summaries={"revenue": Summary("monthly_zone_revenue", marts.monthly_zone_revenue)},
    ),
]
MODELS: dict[str, Model] = {m.name: m for m in _MODELS}

STAGED_SERVICES = tuple(f"stg_{s}" for s in _ALL)
# The final tables in two waves: the second is made of the first
TRIP_MARTS = ("trips", "revenue", "weather_impact")
SUMMARY_MARTS = ("trips_hourly", "weather_daily", "zones_geo")
MONTHLY_MARTS = tuple(m.name for m in _MODELS if m.layer == FINAL and m.partition_by)
SMALL_MARTS = tuple(m.name for m in _MODELS if m.layer == FINAL and not m.partition_by)

RAW_READERS = {
    **{s: None for s in _ALL},
    "weather": raw.read_raw_weather,
    "taxi_zone_lookup": raw.read_zone_lookup,
}


def layer_tables() -> dict[str, dict[str, str]]:
    """Layer -> table -> folder under the base path: what each catalog database lists.

    The zone lookup, raw or staged, serves the builds only and is not listed.
    """
    tables: dict[str, dict[str, str]] = {RAW: {}, STAGING: {}, FINAL: {}}
    for name in (*_ALL, "weather"):
        tables[RAW][name] = raw_path(name)
    for model in MODELS.values():
        if model.stored and model.table != "taxi_zone_lookup":
            tables[model.layer][model.table] = model.path
    tables[STAGING]["taxi_zones_geo"] = staging_path("reference/taxi_zones_geo")
    return tables


def upstream_models(selected: list[str]) -> list[str]:
    """Stored models that building `selected` reads, looking through the unstored ones."""
    found: list[str] = []
    waiting = [d for name in selected for d in MODELS[name].depends_on]
    while waiting:
        name = waiting.pop(0)
        model = MODELS.get(name)
        if model is None or name in selected or name in found:
            continue
        if model.stored:
            found.append(name)
        else:
            waiting.extend(model.depends_on)
    return found


@dataclass
class Lake:
    """A lake on storage. `model_base` redirects every model, read or written, to a sandbox;
    raw files and polygons always come from `source_base`. `limits` are those of the trips in the
    marts; months built with other ones keep them until a full refresh."""

    spark: SparkSession
    source_base: str
    model_base: str | None = None
    limits: Limits = USUAL
    _lookup: DataFrame | None = field(default=None, repr=False)

    def location(self, name: str) -> str:
        return under(self.model_base or self.source_base, MODELS[name].path)

    def source_location(self, path: str) -> str:
        return under(self.source_base, path)

    def read(self, name: str, months: list[str] | None = None) -> DataFrame:
        return read_lake(self.spark, self.location(name), MODELS[name].schema, parse_months(months))

    def read_raw(self, table: str, months: list[str] | None = None) -> DataFrame:
        reader, months = RAW_READERS[table], parse_months(months)
        if reader is None:
            return raw.read_raw_trips(self.spark, self.source_base, table, months)
        return reader(self.spark, self.source_base)

    def forget_lookup(self) -> None:
        """Read the zone lookup anew where it is next used."""
        self._lookup = None

    def zone_lookup(self) -> DataFrame:
        """The staged lookup, measured once for all services of a build."""
        if self._lookup is None:
            self._lookup = broadcast_if_small(self.read("stg_taxi_zone_lookup"))
        return self._lookup

    def _input(self, name: str, months: list[str] | None) -> DataFrame:
        kind, _, table = name.partition(".")
        if kind == "raw":
            return self.read_raw(table, months)
        if kind == "reference":
            return raw.read_zone_polygons(self.spark, self.source_base)
        if not MODELS[name].stored:
            return self.plan(name, months)
        if name == "stg_taxi_zone_lookup":
            return self.zone_lookup()
        # Weather is stored by day, and a day's row per hour is little: it is read whole
        by_month = MODELS[name].partition_by and name != "stg_weather"
        return self.read(name, months if by_month else None)

    def refresh_summary(self, source: str, summary: Summary) -> list[str]:
        """Summarise the months of a stored table that were written since; returns these months."""
        location = under(self.model_base or self.source_base, summary.path)
        months = plan_months(self.spark, [self.location(source)], [location])
        if months:
            write_lake(summary.build(self.read(source, months)), location, PARTITION, months, regroup=True)
        return months

    def summary(self, source: str, summary: Summary) -> DataFrame:
        """The up-to-date summary of a stored table, of the months it now holds."""
        self.refresh_summary(source, summary)
        location = under(self.model_base or self.source_base, summary.path)
        held = list_partitions(self.spark, self.location(source))
        return in_months(read_lake(self.spark, location, summary.schema), held)

    def plan(self, name: str, months: list[str] | None = None) -> DataFrame:
        """The model's rows as a lazy DataFrame, from stored tables and raw files."""
        model, months = MODELS[name], parse_months(months)
        inputs = {
            d: self.summary(d, model.summaries[d]) if d in model.summaries else self._input(d, months)
            for d in model.depends_on
        }
        return model.build(inputs, self.limits)

    def build(self, name: str, months: list[str] | None = None, pending: bool = False) -> None:
        """Write a model, or some months of it: a list, a comma-separated text or one date.

        With `pending` the live table stays as it is until `publish`.
        """
        model, months = MODELS[name], parse_months(months)
        chosen = months if model.partition_by else None
        if name == "stg_taxi_zone_lookup":
            self.forget_lookup()
        location = self.pending_location(name) if pending else self.location(name)
        write_lake(self.plan(name, chosen), location, model.partition_by, chosen, model.regroup, clear=pending)

    def pending_location(self, name: str) -> str:
        return under(self.model_base or self.source_base, pending_path(MODELS[name].path))

    def read_pending(self, name: str, months: list[str] | None = None, built_only: bool = False) -> DataFrame:
        """The table as it will be once its pending build of `months` is published, or the built rows alone."""
        model, months = MODELS[name], parse_months(months)
        built = self.spark.read.schema(model.schema).parquet(self.pending_location(name))
        if built_only or not (months and model.partition_by) or not path_exists(self.spark, self.location(name)):
            return built
        # A month that has no rows any more keeps its live folder
        replaced = [date.fromisoformat(m) for m in list_partitions(self.spark, self.pending_location(name))]
        return self.read(name).where(~F.col(PARTITION).isin(replaced)).unionByName(built)

    def publish(self, name: str, months: list[str] | None = None) -> None:
        """Put the pending build of a model, or of some months of it, in the place of the live files."""
        by_month = bool(parse_months(months) and MODELS[name].partition_by)
        publish(self.spark, self.pending_location(name), self.location(name), by_month)

    def side_by_side(self, work: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
        """Run independent builds at once, so that one's last tasks leave no executor idle."""
        names = list(names)
        if any("stg_taxi_zone_lookup" in MODELS[n].depends_on for n in names if n in MODELS):
            self.zone_lookup()  # measured once for all of them
        with ThreadPoolExecutor(max(1, len(names))) as pool:
            return dict(zip(names, pool.map(work, names)))

    def register_upstream(self, selected: list[str]) -> list[str]:
        """A view for each stored model a partial build depends on."""
        names = upstream_models(selected)
        for name in names:
            self.read(name).createOrReplaceTempView(name)
        return names
