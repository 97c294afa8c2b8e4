"""Exact deduplication against a stored digest index: SQL functions only.

The index holds one row per distinct text, (digest, keep_id), bucketed by digest and sorted by it
within a bucket. A batch is reduced to one row per digest before its first shuffle, so a text that
a third of all rows share is one row per task. A sort-merge anti-join leaves the digests the index
lacks, which are appended. How often a text occurs is counted apart, per batch.

A batch never changes what earlier batches decided: a digest the index has keeps its document. So
`exact_dedup` appends its documents in two batches, those of larger doc_ids first, and the
anti-join leaves each text with its largest doc_id. A batch that is appended again under its name,
after a failure, finds its digests known and replaces its counts: nothing is counted twice.

Defined results: null text is the empty text. Of equal texts the largest doc_id stays; a null doc_id
is smaller than any number. Repeated rows (same doc_id, same text) get the same flag; `deduplicate`
returns one of them. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, free_names, scratch_path

BUCKETS = 64
#: Batches of descending doc_ids that `exact_dedup` appends.
BATCHES = 2
#: A digest with more than this share of all rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-3


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))


class DigestIndex:
    """A persistent index at `path`. Reopen it with the same path and buckets."""

    COUNTS = "digest BINARY, keep_id BIGINT, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        self._declare()

    def _declare(self) -> None:
        where = f"{self.path}/digests".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )
        self.spark.createDataFrame([], self.COUNTS).write.mode("ignore").parquet(self._counts("none"))

    def _counts(self, batch: str) -> str:
        return f"{self.path}/counts/batch={batch}"

    def forget(self) -> None:
        """Take the table's name out of the catalog. Its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self, batches: list[str] | None = None) -> DataFrame:
        """(digest, keep_id, group_size) of the whole index, or of the digests these batches hold.

        group_size counts all batches.
        """
        counted = self.spark.read.schema(f"{self.COUNTS}, batch STRING").parquet(f"{self.path}/counts")
        asked = F.col("batch").isin(batches) if batches else F.lit(True)
        sizes = counted.groupBy("digest").agg(F.sum("group_size").alias("group_size"), F.max(asked).alias("_asked"))
        sizes = sizes.where("_asked").select(F.col("digest").alias("_counted"), "group_size")
        entries = self.spark.table(self.table).join(sizes, F.col("digest") == F.col("_counted"))
        return entries.select("digest", "keep_id", "group_size")

    def append(self, rows: DataFrame, batch: str) -> None:
        """Add the digests of `rows` (doc_id, digest) that the index lacks, and the batch's counts.

        A batch appended again under the same name changes nothing.
        """
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
            raise ValueError(f"no name of a batch: {batch}")
        grouped = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        grouped.write.mode("overwrite").parquet(self._counts(batch))
        found = self.spark.read.schema(self.COUNTS).parquet(self._counts(batch)).select("digest", "keep_id")
        known = self.spark.table(self.table).select(F.col("digest").alias("_known"))
        new = found.hint("merge").join(known, F.col("digest") == F.col("_known"), "left_anti")
        # One file per bucket and append
        (
            new.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/digests")
            .saveAsTable(self.table)
        )


def _descending(rows: DataFrame, parts: int) -> list[DataFrame]:
    """The rows in `parts` ranges of doc_id of about equal size, the largest first, nulls in the last."""
    cuts = rows.approxQuantile("doc_id", [n / parts for n in range(1, parts)], 0.01) if parts > 1 else []
    bounds = sorted({int(cut) for cut in cuts}, reverse=True)
    own, ranges = F.col("doc_id"), []
    for n, low in enumerate(bounds):
        ranges.append(rows.where((own >= low) & (own < bounds[n - 1]) if n else own >= low))
    return [*ranges, rows.where(own.isNull() | (own < bounds[-1])) if bounds else rows]


def decide(docs: DataFrame, index: DigestIndex, batches: int = 1, name: str | None = None) -> DataFrame:
    """Add `docs` to the index and return per row doc_id, keep_id, group_size, kept, text_sha256.

    With an index that already has a text, keep_id is of the batch that brought it and group_size
    counts all batches. `name` names the batches, so that a rerun of a failed call counts once.
    Rows of hot digests meet their entry in a broadcast join of at most 1 / HOT_SHARE entries; the
    others are joined on the digest.
    """
    stored, name = Stored(docs.sparkSession), name or uuid.uuid4().hex
    rows, appended = stored.put(digests(docs)), []
    for n, part in enumerate(_descending(rows, batches)):
        appended.append(f"{name}-{n}")
        index.append(part, appended[-1])
    entries = stored.put(index.rows(appended))
    total = entries.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") > F.greatest(F.lit(1000), F.lit(total) * F.lit(HOT_SHARE))
    named = entries.select(F.col("digest").alias("_key"), "keep_id", "group_size")
    hot, rest = named.where(is_hot), named.where(~is_hot)
    on = F.col("digest") == F.col("_key")
    marked = rows.join(F.broadcast(hot), on, "left")
    known = marked.where(F.col("_key").isNotNull()).drop("_key")
    others = marked.where(F.col("_key").isNull()).drop("_key", "keep_id", "group_size")
    joined = known.unionByName(others.join(rest, on).drop("_key"))
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """`decide` in batches of descending doc_ids, with a fresh index in the shared folder unless one is given."""
    spark = docs.sparkSession
    own = index or DigestIndex(spark, scratch_path(spark))
    decided = decide(docs, own, BATCHES)
    if index is None:
        own.forget()
    return decided


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one row per distinct text.

    Repeated rows are looked for by id and digest; only where there are any are whole rows grouped.
    """
    own_id, own_digest, text = free_names(docs, "_llm_id", "_llm_digest", "_llm_text")
    dropped = exact_dedup(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias(own_id), F.unhex("text_sha256").alias(own_digest)
    ).distinct()
    kept = docs.withColumn(text, digest(F.col("text"))).join(
        dropped,
        F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.col(text) == F.col(own_digest)),
        "left_anti",
    )
    rows = docs.select("doc_id", digest(F.col("text")).alias("_digest"))
    if not rows.groupBy("doc_id", "_digest").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([text])
    return kept.drop(text)
