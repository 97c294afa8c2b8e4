"""Left joins from trips to small lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table within both bounds is copied to every executor
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 2**20
# Metadata of the columns of a lookup beyond these bounds
LARGE = "beyond_broadcast"
# An id with one row in so many is joined apart; rows set apart are spread over so many keys
HOT_SHARE = 200
SPREAD = 1 << 16


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, in one pass that only ever ships partial sums."""
    width = F.octet_length(F.to_csv(F.struct(*[F.col(c).cast("string") for c in df.columns])))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, size


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark a lookup for broadcast if its measured size is bounded.

    A larger one gets the mark LARGE in its columns' metadata, and `left_lookup` joins it by shuffle.
    """
    rows, size = measured_size(df)
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, LARGE: True}) for f in df.schema])


def hot_ids(rows: DataFrame, key: str) -> list[int]:
    """Ids that hold a share of at least 1 in HOT_SHARE of the rows with an id; HOT_SHARE at most."""
    known = rows.where(F.col(key).isNotNull())
    least = known.count() / HOT_SHARE
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return [row[key] for row in counts.where(F.col("n") >= least).select(key).collect()]


def left_lookup(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """`rows` with the columns of `lookup` where integer ids agree, and NULLs where none does.

    A lookup marked LARGE meets the rows in one shuffle. Rows with a hot id meet the few lookup rows
    of hot ids by broadcast instead; they and the rows without an id, which meet nothing, are spread
    over the tasks of that shuffle by keys beyond every 32-bit id. So no task gets the rows of a hot id.
    """
    if not any(f.metadata.get(LARGE) for f in lookup.schema):
        return rows.join(lookup, rows[key] == lookup[lookup_key], "left")
    hot = hot_ids(rows, key)
    apart = F.col(key).isNull() | F.col(key).isin(hot)
    beyond = F.lit(2**31) + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SPREAD))
    names = [c for c in lookup.columns if c != lookup_key]
    keyed = rows.withColumn("__lookup_key", F.when(apart, beyond).otherwise(F.col(key).cast("bigint")))
    cold = lookup.select(F.col(lookup_key).cast("bigint").alias("__cold_key"), *[F.col(c).alias(f"__cold_{c}") for c in names])
    found = keyed.join(cold, keyed["__lookup_key"] == cold["__cold_key"], "left")
    # Measured again, as nothing here says that a lookup has one row an id
    few = broadcast_if_small(lookup.where(F.col(lookup_key).isin(hot)))
    found = found.join(few, found[key] == few[lookup_key], "left")
    both = [F.coalesce(F.col(c), F.col(f"__cold_{c}")).alias(c) for c in names]
    matched = F.coalesce(F.col(lookup_key), F.col("__cold_key").cast(lookup.schema[lookup_key].dataType))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], matched.alias(lookup_key), *both)


def with_zones(trips: DataFrame, lookup: DataFrame, pickup_id: str, dropoff_id: str) -> DataFrame:
    """Add zone and borough of both ends; an id without a lookup row gives NULLs.

    `lookup` should come from `broadcast_if_small`, checked once for all services.
    """
    for end, key in (("pickup", pickup_id), ("dropoff", dropoff_id)):
        side = lookup.select(
            F.col("location_id").alias(f"{end}_location_key"),
            F.col("zone").alias(f"{end}_zone"),
            F.col("borough").alias(f"{end}_borough"),
        )
        trips = left_lookup(trips, side, key, f"{end}_location_key").drop(f"{end}_location_key")
    return trips
