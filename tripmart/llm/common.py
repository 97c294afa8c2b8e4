"""Stored intermediate tables, global ranks and connected components."""

from __future__ import annotations

import atexit
import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripmart.workspace import new_workspace

_FOLDERS: dict[tuple[str, str], str] = {}
#: Bytes of a batch that goes to a Python worker, about; a longer row goes alone.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _clean_up(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session has ended before the process
        pass


def scratch_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share. It is removed when the process ends."""
    key = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None) or "")
    if key not in _FOLDERS:
        _FOLDERS[key] = new_workspace(spark, "llm")
        atexit.register(_clean_up, spark, _FOLDERS[key])
    return f"{_FOLDERS[key]}/{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Bound batches in bytes, unless the session does so itself.

    Spark's usual bound of rows makes one batch of a whole partition of long texts, which each task
    holds in the JVM and again in its Python worker. No result depends on where batches end.
    """
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


class Stored:
    """Tables written once and read back: they cut the lineage and outlive any executor."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        bound_batches(spark)

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._llm_path = path
        return stored

    def drop(self, df: DataFrame | None) -> None:
        """Remove a table of `put` that no later step reads."""
        path = getattr(df, "_llm_path", None)
        if path:
            _delete(self.spark, path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as it takes to be unlike every column of `df`."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def worker_state() -> dict:
    """A dict that lives as long as the Python worker: shipped functions have no lasting globals."""
    return sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


def forget_worker_state() -> None:
    """Drop what earlier operators remembered in this worker. Functions that remember nothing begin with it."""
    state = worker_state()
    for name in [n for n in state if not n.startswith("__")]:
        del state[name]


def with_place(df: DataFrame) -> DataFrame:
    """Adds `_part` and `_at`, a row's partition and its place there. Store the result at once."""
    return df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )


def with_rank(placed: DataFrame, name: str = "_rank") -> DataFrame:
    """Number the rows of a stored `with_place` table from 0, by partition and place.

    The broadcast table has one row per partition of the stored table.
    """
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    return (
        placed.join(F.broadcast(firsts), F.col("_part") == F.col("_of"))
        .withColumn(name, F.col("_first") + F.col("_at"))
        .drop("_part", "_at", "_of", "_first")
    )


def components(edges: DataFrame, stored: Stored) -> DataFrame:
    """Connected components of `edges` (a, b) of one orderable type: rows (node, component).

    Large-star and small-star rounds: every round points a node's larger, then its smaller
    neighbours to the smallest one, so paths shrink as in pointer jumping. A round is a minimum per
    node, combined before the shuffle, and a join; neighbours are never collected. It ends when a
    round changes nothing. Nodes without an edge do not appear. component is the smallest node.
    """
    now = stored.put(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored.put(
            both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = stored.put(
            moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(moved.select("a", F.col("m").alias("b")))
            .distinct()
        )
        new = small.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        stored.drop(now)
        stored.drop(large)
        now = small
        if new == mark:
            break
        mark = new
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())
