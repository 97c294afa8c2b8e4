"""Data tests. Each yields the failing rows; a passing test yields none."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.rounding import round_half_away
from tripmart.operators.dimensions import broadcast_if_small

ERROR, WARN = "error", "warn"
#: Partitions before one that its volume is compared with.
LOOKBACK = 3


@dataclass(frozen=True)
class Check:
    """One declared test: `kind` names a rule below, `column` is what it looks at."""

    kind: str
    column: str | None = None
    severity: str = ERROR
    arguments: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "_".join(p for p in (self.kind, self.column) if p)


# --- tests of single rows: the condition that marks a failing row ---------------------------


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unlisted(column: str, values: list) -> Column:
    """Outside the accepted values; NULL passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def is_out_of_range(
    column: str, minimum: float | None = None, maximum: float | None = None
) -> Column:
    """Below the minimum or above the maximum, where given; NULL passes."""
    bounds = []
    if minimum is not None:
        bounds.append(F.col(column) < minimum)
    if maximum is not None:
        bounds.append(F.col(column) > maximum)
    return F.col(column).isNotNull() & reduce(lambda a, b: a | b, bounds, F.lit(False))


ROW_RULES = {
    "not_null": is_missing,
    "accepted_values": is_unlisted,
    "accepted_range": is_out_of_range,
}


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.where(ROW_RULES[check.kind](check.column, **check.arguments))


# --- tests of whole tables ------------------------------------------------------------------


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, NULL aside, with their number of rows."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def missing_in_lookup(df: DataFrame, column: str, lookup: DataFrame, key: str) -> DataFrame:
    """Values of a column with no lookup row, with their number of rows.

    Rows are counted per value before the join, so what is shuffled is one row per value and
    task, and no key is too frequent.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column)
    used = used.agg(F.count(F.lit(1)).alias("n_records"))
    return used.join(lookup.select(F.col(key).alias("known")), used[column] == F.col("known"), "left_anti")


def repeated_hashes(df: DataFrame) -> DataFrame:
    """64-bit hashes of whole rows that occur more than once. Only hashes are shuffled."""
    hashed = df.select(F.xxhash64(*df.columns).alias("row_hash")).groupBy("row_hash")
    return hashed.agg(F.count(F.lit(1)).alias("n_same")).where("n_same > 1").select("row_hash")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in every column; no row if none does.

    Equal rows have equal hashes, so rows are compared whole only where a hash occurs twice. As a
    rule that is none, and the table is never shuffled; the hashes are broadcast while they are few.
    """
    suspects = repeated_hashes(df)
    if suspects.isEmpty():
        return df.sparkSession.createDataFrame([], "duplicate_rows bigint")
    same = F.xxhash64(*[df[c] for c in df.columns]) == F.col("row_hash")
    met = df.join(broadcast_if_small(suspects), same, "left_semi")
    groups = met.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n_same"))
    extra = groups.agg(F.coalesce(F.sum(F.col("_n_same") - 1), F.lit(0)).alias("duplicate_rows"))
    return extra.where("duplicate_rows > 0")


def rows_per_partition(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("partition_value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def with_previous_average(counts: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Each partition beside the mean size of the ones before it.

    The window has no partitioning, but only sees one row per month.
    """
    before = Window.orderBy("partition_value").rowsBetween(-lookback, -1)
    return counts.withColumn("previous_avg", F.avg("row_count").over(before))


def is_odd_volume(min_ratio: float = 0.5, max_ratio: float = 2.0) -> Column:
    usual = F.col("previous_avg")
    odd = (F.col("row_count") < usual * min_ratio) | (F.col("row_count") > usual * max_ratio)
    return usual.isNotNull() & odd


def odd_volumes(
    df: DataFrame,
    column: str,
    min_ratio: float = 0.5,
    max_ratio: float = 2.0,
    lookback: int = LOOKBACK,
) -> DataFrame:
    """Partitions far smaller or larger than those before; the first has nothing to compare."""
    compared = with_previous_average(rows_per_partition(df, column), lookback)
    odd = compared.where(is_odd_volume(min_ratio, max_ratio))
    return odd.withColumn("previous_avg", round_half_away(F.col("previous_avg")))


def unreconciled(trips: DataFrame, **marts: DataFrame) -> DataFrame:
    """Marts whose `trips` measure does not add up to the number of trips.

    The one-row totals are stacked and folded into one row, so nothing is cross-joined.
    """
    totals = trips.agg(F.lit("trips").alias("source"), F.count(F.lit(1)).alias("total"))
    for name, mart in marts.items():
        totals = totals.unionByName(
            mart.agg(F.lit(name).alias("source"), F.sum("trips").alias("total"))
        )

    def total_of(name: str) -> Column:
        return F.max(F.when(F.col("source") == name, F.col("total")))

    rows = [
        F.struct(F.lit(name).alias("mart"), total_of(name).alias("mart_trips")) for name in marts
    ]
    folded = totals.agg(F.array(*rows).alias("marts"), total_of("trips").alias("trips"))
    compared = folded.select(F.inline("marts"), "trips").select("mart", "mart_trips", "trips")
    return compared.where(F.col("mart_trips") != F.col("trips"))


def trips_by_partition(mart: DataFrame, column: str, measure: Column) -> DataFrame:
    """One side of `unreconciled_partitions`."""
    return mart.groupBy(F.col(column).alias("partition_value")).agg(measure.cast("bigint").alias("trips"))


def unreconciled_partitions(trips: DataFrame, **marts: DataFrame) -> DataFrame:
    """Marts and partitions whose trips do not add up to those of the trips table.

    All sides have one row per partition (partition_value, trips); where one lacks it, it has no trips.
    """
    sides = [(None, trips), *marts.items()]
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).cast("string").alias("mart"), "partition_value", "trips") for name, df in sides],
    )
    own, of_marts = F.sum(F.when(F.col("mart").isNull(), F.col("trips"))), []
    for name in marts:
        in_mart = F.coalesce(F.sum(F.when(F.col("mart") == name, F.col("trips"))), F.lit(0))
        of_marts.append(F.struct(F.lit(name).alias("mart"), in_mart.alias("mart_trips")))
    folded = stacked.groupBy("partition_value").agg(
        F.array(*of_marts).alias("marts"), F.coalesce(own, F.lit(0)).alias("trips")
    )
    compared = folded.select("partition_value", F.inline("marts"), "trips")
    return compared.select("mart", "partition_value", "mart_trips", "trips").where("mart_trips <> trips")


# --- running a table's tests ----------------------------------------------------------------


def count_row_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All single-row tests of a table in one scan: one row per test with its failures."""
    counts = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.severity).alias("severity"),
            F.count_if(ROW_RULES[c.kind](c.column, **c.arguments)).alias("failures"),
        )
        for c in checks
    ]
    return df.agg(F.array(*counts).alias("results")).select(F.inline("results"))


def count_together(
    df: DataFrame,
    checks: list[Check],
    lookups: dict[str, DataFrame] | None = None,
    partitions: list | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Tests of single rows, of references and of one column's volumes, all from one scan.

    Rows are counted per partition and referenced values first: the lookups are joined to one row
    per combination, and no value is too frequent. With partitions, failures are counted in these
    only, and the others are what their volumes are compared with; `earlier` has more such volumes
    (partition_value, row_count).
    """
    volume = next((c for c in checks if c.kind == "partition_volume"), None)
    references = [c for c in checks if c.kind == "relationships"]
    failed = {n: f"_failed_{n}" for n, c in enumerate(checks) if c is not volume}
    keys = dict.fromkeys(c.column for c in ([volume] if volume else []) + references)
    found = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(ROW_RULES[c.kind](c.column, **c.arguments)).alias(failed[n])
            for n, c in enumerate(checks)
            if c.kind in ROW_RULES
        ],
    )
    for n, check in enumerate(checks):
        if check in references:
            lookup, own, known = lookups[check.arguments["to"]], F.col(check.column), f"_known_{n}"
            values = lookup.select(F.col(check.arguments["field"]).alias(known)).distinct()
            missing = own.isNotNull() & F.col(known).isNull()
            found = found.join(values, own == F.col(known), "left").withColumn(
                failed[n], F.when(missing, F.col("_rows")).otherwise(0)
            )
    sums = [F.sum(name).alias(name) for name in failed.values()]
    if volume:
        limits = dict(volume.arguments)
        totals = found.groupBy(F.col(volume.column).alias("partition_value")).agg(
            F.sum("_rows").alias("row_count"), *sums
        )
        if earlier is not None:
            none = [F.lit(0).cast("bigint").alias(name) for name in failed.values()]
            totals = totals.unionByName(earlier.select("partition_value", "row_count", *none))
        found = with_previous_average(totals, limits.pop("lookback", LOOKBACK))
        found = found.withColumn("_odd", is_odd_volume(**limits))
        if partitions:
            found = found.where(F.col("partition_value").isin(partitions))

    def failures(n: int) -> Column:
        if n not in failed:
            return F.count_if("_odd")
        return F.coalesce(F.sum(failed[n]), F.lit(0)).cast("bigint")

    counts = [
        F.struct(
            F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), failures(n).alias("failures")
        )
        for n, c in enumerate(checks)
    ]
    return found.agg(F.array(*counts).alias("results")).select(F.inline("results"))


def _counted(failures: DataFrame, check: Check, amount: Column) -> DataFrame:
    return failures.agg(
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(amount, F.lit(0)).cast("bigint").alias("failures"),
    )


def run_checks(
    df: DataFrame,
    checks: list[Check],
    lookups: dict[str, DataFrame] | None = None,
    partitions: list | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Test name, severity and number of failures for every declared test of a table.

    With partitions, which needs a test of volumes, only these are tested; `earlier` has the volumes
    of others that `df` does not hold.
    """
    volumes = [c for c in checks if c.kind == "partition_volume"]
    together = [c for c in checks if c.kind in (*ROW_RULES, "relationships")] + volumes[:1]
    if len(volumes) > 1 or (partitions and not volumes):
        raise ValueError("one test of volumes names the partitions of a table")
    if volumes or any(c.kind == "relationships" for c in together):
        results = [count_together(df, together, lookups, partitions, earlier)]
    else:
        results = [count_row_failures(df, together)] if together else []
    tested = df.where(F.col(volumes[0].column).isin(partitions)) if partitions else df
    for check in checks:
        if check.kind == "unique":
            failed = repeated_values(tested, check.column)
            results.append(_counted(failed, check, F.count(F.lit(1))))
        elif check.kind == "no_duplicate_rows":
            results.append(_counted(duplicate_rows(tested), check, F.sum("duplicate_rows")))
        elif check not in together:
            raise ValueError(f"unknown test: {check.kind}")
    return reduce(DataFrame.unionByName, results)


class ChecksFailed(RuntimeError):
    """Tests of error severity found rows."""


def gate(results: DataFrame, table: str) -> list:
    """Stop if a test of error severity failed; return what only warned."""
    failed = results.where("failures > 0").collect()
    errors = [f"{r['check']}: {r['failures']}" for r in failed if r["severity"] == ERROR]
    if errors:
        raise ChecksFailed(f"{table}: " + ", ".join(sorted(errors)))
    return [r for r in failed if r["severity"] == WARN]
