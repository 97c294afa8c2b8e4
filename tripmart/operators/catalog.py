"""Registering written tables in the Spark catalog.

Raw months whose types drift cannot share one table. They get a table per group of months that agree,
and a view of the united columns under the name that readers use.
"""

from __future__ import annotations

import zlib

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tripmart.paths import PARTITION
from tripmart.sources.lake import declared, path_exists
from tripmart.sources.raw import layout_groups, united_columns, united_fields

_SCALARS = {
    T.StringType: "string",
    T.BooleanType: "boolean",
    T.ByteType: "tinyint",
    T.ShortType: "smallint",
    T.IntegerType: "int",
    T.LongType: "bigint",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.DateType: "date",
    T.TimestampNTZType: "timestamp_ntz",
    T.TimestampType: "timestamp",
    T.BinaryType: "binary",
}


def catalog_type(data_type: T.DataType) -> str:
    """The catalog's name for a scalar type; nested types and intervals are refused."""
    if isinstance(data_type, T.DecimalType):
        return data_type.simpleString()
    name = _SCALARS.get(type(data_type))
    if name is None:
        raise ValueError(f"the catalog holds scalar columns only, not {data_type.simpleString()}")
    return name


def catalog_columns(schema: T.StructType) -> str:
    """DDL of a file schema: names in lower case, the first of clashing spellings kept."""
    columns: dict[str, str] = {}
    for field in schema:
        columns.setdefault(field.name.lower(), catalog_type(field.dataType))
    partition = columns.pop(PARTITION, None)
    if partition:
        columns[PARTITION] = partition
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def _quoted(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_external_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    file_format: str = "parquet",
    schema: str | T.StructType | None = None,
) -> None:
    """A table over files that already exist. JSON needs a declared schema."""
    if file_format == "json" and schema is None:
        raise ValueError(f"{table}: a JSON table needs a schema")
    if not path_exists(spark, location):
        raise FileNotFoundError(f"no data at {location}: build {table} first")
    reader = spark.read.format(file_format)
    if schema:
        reader = reader.schema(schema)
    found = reader.load(location).schema
    partitioned = f"PARTITIONED BY ({PARTITION})" if PARTITION in found.names else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(
        f"CREATE TABLE {_quoted(database, table)} ({catalog_columns(found)}) "
        f"USING {file_format} {partitioned} LOCATION {_text(location)}"
    )


def sync_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Add new month folders and drop vanished ones; a table without months is refreshed."""
    name = _quoted(database, table)
    columns = spark.catalog.listColumns(f"{database}.{table}")
    if any(c.isPartition for c in columns):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    else:
        spark.sql(f"REFRESH TABLE {name}")


def repair_table(
    spark: SparkSession, database: str, table: str, location: str, **how
) -> None:
    """Create the table if it is missing, then sync its months."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(f"{database}.{table}"):
        create_external_table(spark, database, table, location, **how)
    sync_partitions(spark, database, table)


def recreate_tables(
    spark: SparkSession, database: str, locations: dict[str, str], **how
) -> None:
    """Drop each table (its files stay) and register it anew from the files' schema."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table, location in locations.items():
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, table)}")
        create_external_table(spark, database, table, location, **how)
        sync_partitions(spark, database, table)


def _tables_like(spark: SparkSession, database: str, prefix: str) -> set[str]:
    shown = spark.sql(f"SHOW TABLES IN `{database}`").where("not isTemporary").collect()
    return {row["tableName"] for row in shown if row["tableName"].startswith(prefix)}


def _sync_folders(spark: SparkSession, name: str, folders: dict[str, str]) -> None:
    """The table's months become the given ones, each at its own folder."""
    held = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for verb, months in (("DROP IF EXISTS", held - folders.keys()), ("ADD IF NOT EXISTS", folders.keys() - held)):
        parts = []
        for month in sorted(months):
            place = f" LOCATION {_text(folders[month])}" if verb.startswith("ADD") else ""
            parts.append(f"PARTITION ({PARTITION} = DATE '{month}'){place}")
        if parts:
            separator = " " if verb.startswith("ADD") else ", "
            spark.sql(f"ALTER TABLE {name} {verb} {separator.join(parts)}")
    spark.sql(f"REFRESH TABLE {name}")


def _month_of(path: str) -> str:
    return path.partition(f"/{PARTITION}=")[2].partition("/")[0]


def repair_layouts(
    spark: SparkSession, database: str, table: str, location: str, schema: str = ""
) -> list[str]:
    """A view `table` over all months at `location`, whatever columns and types each month has.

    Every group of months that can share a scan is an external table of its own; a file whose month
    holds other types beside it is one too. Their names follow from their columns, so a new month of a
    known layout is a new partition and nothing else. `schema` declares the types of known columns.
    Run again, it adds and drops months, tables of new and vanished layouts, and renews the view.
    Returns the names of the tables below the view.
    """
    groups = layout_groups(spark, location)
    if not groups:
        raise FileNotFoundError(f"no data at {location}: build {table} first")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    targets = united_fields([layout for layout, _ in groups], declared(schema) if schema else T.StructType())
    targets = {key: T.StructField(key, f.dataType) for key, f in targets.items() if key != PARTITION}
    prefix = f"{table.lower()}__layout_"
    tables, selects = {}, []
    for layout, members in groups:
        layout = T.StructType([f for f in layout if f.name.lower() != PARTITION])
        columns = catalog_columns(layout)
        folders = {_month_of(m): m for m in members if m.rstrip("/").endswith(f"{PARTITION}={_month_of(m)}")}
        places = [(f"{columns}, {PARTITION} date", folders, PARTITION)] if folders else []
        places += [(columns, m, f"DATE '{_month_of(m)}' AS {PARTITION}") for m in members if m not in folders.values()]
        for ddl, place, month in places:
            key = f"{ddl} {location if isinstance(place, dict) else place}"
            name = f"{prefix}{zlib.crc32(key.encode()):08x}"
            tables[name] = (ddl, place)
            fields = ", ".join([*united_columns(layout, targets), month])
            selects.append(f"SELECT {fields} FROM {_quoted(database, name)}")
    for name in _tables_like(spark, database, prefix) - tables.keys():
        spark.sql(f"DROP TABLE {_quoted(database, name)}")
    for name, (ddl, place) in tables.items():
        quoted, by_month = _quoted(database, name), isinstance(place, dict)
        if not spark.catalog.tableExists(f"{database}.{name}"):
            how = f"PARTITIONED BY ({PARTITION}) LOCATION {_text(location)}" if by_month else f"LOCATION {_text(place)}"
            spark.sql(f"CREATE TABLE {quoted} ({ddl}) USING parquet {how}")
        if by_month:
            _sync_folders(spark, quoted, place)
        else:
            spark.sql(f"REFRESH TABLE {quoted}")
    view = _quoted(database, table)
    if spark.catalog.tableExists(f"{database}.{table}") and spark.catalog.getTable(f"{database}.{table}").tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(selects)}")
    return sorted(tables)
