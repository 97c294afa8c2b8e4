"""Raw files as landed: trips whose columns drift between months, weather, zones."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmart.functions.casts import int_column
from tripmart.functions.clock import nanos_to_wall_clock
from tripmart.paths import PARTITION, raw_path, under
from tripmart.sources import schemas
from tripmart.sources.lake import declared, list_files, partition_times

FOOTER_THREADS = 16
_KNOWN_LAYOUTS: dict[tuple[str, datetime], dict[str, T.StructType]] = {}
_NUMBERS = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.FloatType,
    T.DoubleType,
)


def _wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type both fit in: the later number type, else text."""
    if left == right:
        return left
    if isinstance(left, _NUMBERS) and isinstance(right, _NUMBERS):
        ranks = [next(i for i, n in enumerate(_NUMBERS) if isinstance(t, n)) for t in (left, right)]
        top = max(ranks)
        if _NUMBERS[top] in (T.DecimalType, T.FloatType):
            return T.DoubleType()
        return _NUMBERS[top]()
    return T.StringType()


#: Marks a column of 64-bit nanosecond times, which Spark reads as whole numbers only.
NANOS = {"time_unit": "ns"}


def _is_nanos(field: T.StructField) -> bool:
    return field.metadata == NANOS


def column_type(field: T.StructField) -> T.DataType:
    """The type a column of a layout has once it is united."""
    return T.TimestampNTZType() if _is_nanos(field) else field.dataType


def united_fields(layouts: list[T.StructType], schema: T.StructType) -> dict[str, T.StructField]:
    """The columns of some layouts together, by lower-case name.

    Declared columns keep their type and spelling. Undeclared ones get the widest type met and the
    spelling met first.
    """
    declared_names = {f.name.lower() for f in schema}
    targets = {f.name.lower(): T.StructField(f.name, f.dataType) for f in schema}
    for layout in layouts:
        for field in layout:
            key, kind = field.name.lower(), column_type(field)
            if key not in targets:
                targets[key] = T.StructField(field.name, kind)
            elif key not in declared_names:
                targets[key] = T.StructField(targets[key].name, _wider(targets[key].dataType, kind))
    return targets


def united_columns(layout: T.StructType, targets: dict[str, T.StructField]) -> list[str]:
    """SQL for each united column from a layout's columns; one it lacks is NULL."""
    present = {f.name.lower(): f for f in layout}

    def value(key: str, wanted: T.DataType) -> str:
        if key not in present:
            return "null"
        field = present[key]
        name = "`" + field.name.replace("`", "``") + "`"
        if _is_nanos(field):
            return nanos_to_wall_clock(name)
        if isinstance(wanted, T.IntegralType) and isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return f"rint({name})"  # a bare cast would cut the fraction off
        if isinstance(wanted, T.IntegralType) and isinstance(field.dataType, T.DecimalType):
            return f"round({name}, 0)"
        return name

    return [
        f"cast({value(key, field.dataType)} as {field.dataType.simpleString()}) as `{field.name.replace('`', '``')}`"
        for key, field in targets.items()
    ]


def union_by_name(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Stack frames by column name, ignoring the names' case; see `united_fields`."""
    targets = united_fields([frame.schema for frame in frames], schema)
    aligned = [frame.selectExpr(*united_columns(frame.schema, targets)) for frame in frames]
    return reduce(DataFrame.unionByName, aligned)


def _nano_columns(spark: SparkSession, file: str) -> set[str]:
    """Columns of nanosecond times, by the file's footer."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        fields = footer.getFileMetaData().getSchema().getFields()
        return {f.getName() for f in fields if str(f.getLogicalTypeAnnotation()).startswith("TIMESTAMP(NANOS")}
    finally:
        footer.close()


def _refused_times(error: Exception) -> bool:
    return "PARQUET_TYPE_ILLEGAL" in str(error)


def _file_layout(spark: SparkSession, file: str) -> T.StructType:
    """The columns of one file. Nanosecond times are whole numbers marked NANOS."""
    nanos = _nano_columns(spark, file)
    if not nanos:
        return spark.read.parquet(file).schema
    # Only this look at the footer needs the setting: a scan takes the whole numbers as they are
    other = spark.newSession()
    other.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    fields = other.read.parquet(file).schema
    return T.StructType([T.StructField(f.name, f.dataType, True, NANOS) if f.name in nanos else f for f in fields])


def _folder_layouts(spark: SparkSession, folder: str) -> dict[str, T.StructType]:
    """The columns of a month from the footers of all its files: of the folder, or of each file if types differ."""
    try:
        return {folder: spark.read.option("mergeSchema", True).parquet(folder).schema}
    except Exception as error:
        if not ("CANNOT_MERGE" in str(error) or "merge" in str(error).lower() or _refused_times(error)):
            raise
    files = sorted(row["path"] for row in list_files(spark, folder).select("path").collect())
    found = {file: _file_layout(spark, file) for file in files}
    first = found[files[0]]
    return {folder: first} if all(layout == first for layout in found.values()) else found


def month_layouts(spark: SparkSession, written: dict[str, datetime]) -> dict[str, T.StructType]:
    """Columns and types by path: a month folder, or each of its files where their types differ.

    All footers of a folder are read, a few folders at a time. Layouts are remembered until the
    folder is written again.
    """
    unknown = [key for key in written.items() if key not in _KNOWN_LAYOUTS]
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        found = pool.map(lambda key: _folder_layouts(spark, key[0]), unknown)
        _KNOWN_LAYOUTS.update(zip(unknown, found))
    return {path: layout for key in written.items() for path, layout in _KNOWN_LAYOUTS[key].items()}


def compatible_groups(
    layouts: dict[str, T.StructType],
) -> list[tuple[T.StructType, list[str]]]:
    """Months whose common columns have the same types can share a scan.

    Added, lost and re-spelled columns do not split a group; a changed type does. There are as many
    groups as type changes need, however many months there are.
    """

    def kind(field: T.StructField) -> tuple:
        return field.dataType, _is_nanos(field)

    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for folder, layout in layouts.items():
        fields = {f.name.lower(): f for f in layout}
        for known, members in groups:
            if all(kind(known[k]) == kind(f) for k, f in fields.items() if k in known):
                for key, field in fields.items():
                    known.setdefault(key, field)
                members.append(folder)
                break
        else:
            groups.append((fields, [folder]))
    return [(T.StructType(list(known.values())), members) for known, members in groups]


def layout_groups(
    spark: SparkSession, location: str, months: list[str] | None = None
) -> list[tuple[T.StructType, list[str]]]:
    """`compatible_groups` of the months a folder holds."""
    times = {
        f"{location.rstrip('/')}/{PARTITION}={row[PARTITION].isoformat()}": row["modified"]
        for row in partition_times(spark, location, months).orderBy(PARTITION).collect()
    }
    return compatible_groups(month_layouts(spark, times))


def read_raw_trips(
    spark: SparkSession, base: str, table: str, months: list[str] | None = None
) -> DataFrame:
    """All (or the given) months of one service, columns united by name."""
    root = under(base, raw_path(table))
    united = declared(f"{schemas.RAW[table]}, {PARTITION} date")
    groups = layout_groups(spark, root, months)
    if not groups:
        return spark.createDataFrame([], united)
    reader = spark.read.option("basePath", root)
    scans = [reader.schema(layout).parquet(*members) for layout, members in groups]
    return union_by_name(scans, united)


def read_raw_weather(spark: SparkSession, base: str) -> DataFrame:
    """JSON Lines, one file per day; the folder's day becomes a column.

    Whole numbers may be written as 61.0. A line that cannot be read fails the scan.
    """
    written = schemas.RAW_WEATHER.replace(" int", " double")
    rows = spark.read.schema(written).option("mode", "FAILFAST").json(under(base, raw_path("weather")))
    return rows.select(
        *[
            int_column(rows, name).alias(name) if schemas.HOURLY_VARIABLES.get(name) == "int" else name
            for name in rows.columns
        ]
    )


def read_zone_lookup(spark: SparkSession, base: str) -> DataFrame:
    """CSV with a header, checked against the expected column names."""
    return (
        spark.read.schema(schemas.RAW_ZONE_LOOKUP)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(under(base, raw_path("reference/taxi_zone_lookup")))
    )


def read_zone_polygons(spark: SparkSession, base: str) -> DataFrame:
    location = under(base, "staging/reference/taxi_zones_geo")
    return spark.read.schema(schemas.STAGING["taxi_zones_geo"]).parquet(location)
