"""Mixing sources to target weights by Poisson replication.

The rate of a source is its target share of the whole volume over its own volume. A document is
repeated as often as the inverse of a Poisson distribution with that mean says at a uniform number
hashed from its doc_id and a seed, so a rerun or a lost executor repeats nothing differently. The
copies are put in a global order by a second hash: a range exchange of documents, no sort by source.
Volumes are one row per task and source before they are shuffled. Volumes and rates of sources are
joined by broadcast after a check of their size, else by shuffle.

Defined results: a null source is a source of its own. Sources without a target get their natural
share of what the named targets leave. A document of null or empty text adds no volume and is repeated
at its source's rate. A null doc_id hashes as an empty text. Repeated rows have the same count and
are placed side by side. Empty tables give empty results; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import free_names
from tripmart.operators.dimensions import broadcast_if_small

SEED = 7
#: The natural share of a source is raised to this power and scaled to sum 1.
TEMPERATURE = 0.7


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits of an MD5."""
    joined = F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def source_rates(docs: DataFrame, targets: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """Rows (source, volume, target, rate); volume is in characters.

    `targets` are shares by source; without them a source's natural share raised to `temperature`.
    """
    volume = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("volume"))
    volume = volume.where("volume > 0")
    total = volume.agg(F.sum("volume").alias("_total"), F.sum(F.pow(F.col("volume").cast("double"), F.lit(temperature))).alias("_powers"))
    every = volume.join(F.broadcast(total))  # one row
    if targets is None:
        target = F.pow(F.col("volume").cast("double"), F.lit(temperature)) / F.col("_powers")
    else:
        named = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair]) if targets else None
        own = named[F.col("source")] if targets else F.lit(None).cast("double")
        left = max(0.0, 1.0 - sum(targets.values()))
        unnamed = F.sum(F.when(own.isNull(), F.col("volume"))).alias("_unnamed")
        every = every.join(F.broadcast(every.agg(unnamed)))  # one row
        target = F.coalesce(own, F.lit(left) * F.col("volume") / F.col("_unnamed"))
    return every.select("source", "volume", target.alias("target"), (target * F.col("_total") / F.col("volume")).alias("rate"))


#: exp(-rate) is 0 in double precision for rates over about 745.
LARGE_RATE = 700.0


def first_step(rate: Column) -> Column:
    """Where `poisson_steps` starts: 0, or 10 deviations below a large rate."""
    return F.when(rate <= LARGE_RATE, F.lit(0)).otherwise(F.floor(rate - 10 * F.sqrt(rate) - 30)).cast("int")


def poisson_steps(rate: Column) -> Column:
    """The distribution function at `first_step` and on, up to where less than 2**-52 is left.

    For a large rate the terms are relative to the first one and are divided by their sum.
    """
    most = F.ceil(rate + 10 * F.sqrt(rate) + 30).cast("int")
    large = rate > LARGE_RATE
    one = F.when(large, F.lit(1.0)).otherwise(F.exp(-rate))
    start = F.struct(one.alias("p"), one.alias("c"), F.array(one).alias("all"))
    return F.aggregate(
        F.sequence(first_step(rate) + 1, most),
        start,
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            (s["c"] + s["p"] * rate / k).alias("c"),
            F.concat(s["all"], F.array(s["c"] + s["p"] * rate / k)).alias("all"),
        ),
        lambda s: F.when(large, F.transform(s["all"], lambda c: c / s["c"])).otherwise(s["all"]),
    )


def mix(
    docs: DataFrame, targets: dict[str, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED
) -> DataFrame:
    """All columns of `docs` and `_replica` (from 0) and `_order`, in the order of `_order`.

    The two names get underscores more where `docs` has such columns; they are the last ones in any case.
    """
    source, least, cuts, count, replica, order = free_names(docs, "_source", "_least", "_steps", "_times", "_replica", "_order")
    rates = source_rates(docs, targets, temperature)
    steps = broadcast_if_small(rates.select(F.col("source").alias(source), first_step(F.col("rate")).alias(least), poisson_steps(F.col("rate")).alias(cuts)))
    joined = docs.join(steps, F.col("source").eqNullSafe(F.col(source)), "left")
    draw = uniform(F.lit("count"), F.lit(seed), F.col("doc_id"))
    # A source of no volume holds empty documents only: they pass once
    times = F.when(F.col(cuts).isNull(), F.lit(1)).otherwise(F.col(least) + F.size(F.filter(cuts, lambda c: c <= draw)))
    copies = joined.withColumn(count, times).where(F.col(count) > 0).withColumn(
        replica, F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    )
    key = uniform(F.lit("order"), F.lit(seed), F.col("doc_id"), F.col(replica))
    placed = copies.select(*[docs[c] for c in docs.columns], replica, key.alias(order))
    return placed.repartitionByRange(F.col(order)).sortWithinPartitions(order)
