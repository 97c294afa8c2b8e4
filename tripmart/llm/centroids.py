"""Lloyd's clustering with the components dealt over shards.

A vector's components are cut into column blocks, and blocks of rows of one shard are stored as one
record. In a round, a task turns the columns it holds into exact partial distances to its slice of every
centroid. The partial distances of a block of rows meet by key, are added, and the nearest centroid is
taken. There every shard's columns are summed by cluster; the sums of all blocks are added per shard,
cluster and component, and each shard divides its own slice. Only the centroids, k times the number of
components, pass through the driver: their size is a parameter, not the table's.

Arithmetic is on integers throughout: floating-point products are used only where they are exact.

Defined results: a vector that is null, has another number of components, or holds a null or non-finite
one is left out. Rows of equal vec_id are vectors of their own; where they tie for a first centroid, the
one with the smaller components comes first. Vectors with a null vec_id are clustered and returned, and
are first centroids only after all others. With fewer vectors than k, each is a centroid; an empty table
gives no rows. A component beyond LIMIT in magnitude after scaling fails the run, because its squares
would not fit in a long. Other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import scratch_path

COMPONENTS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SHARDS = 4
#: Vectors of one block.
BLOCK = 2048
LIMIT = 1 << 27
#: Up to this magnitude products and sums of a column block are exact in double precision.
_DOUBLE_LIMIT = 1 << 22

_LAYOUT = "block bigint, n int, ids array<bigint>, cells binary, shard int"
_PARTIAL = "block bigint, shard int, n int, ids array<bigint>, cells binary, wide boolean, distances binary"


def _whole(x) -> object:
    return F.floor(x.cast("double") * SCALE).cast("bigint")


def sound(vectors: DataFrame, components: int) -> DataFrame:
    """Rows (vec_id, v) of the vectors that take part, v as integers."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where((F.size(e) == components) & finite)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(e, _whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int, components: int, seed: int) -> list[list[int]]:
    """The k vectors of smallest hash, in that order. Every task keeps k rows at most."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = sound(vectors, components).select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k)
    return [row["v"] for row in rows.collect()]


def _columns(components: int, shards: int) -> list[tuple[int, int]]:
    edges = [components * i // shards for i in range(shards + 1)]
    return list(zip(edges, edges[1:]))


def _laid_out(batches, components: int, shards: int, block: int):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        batch = batch.filter(pc.equal(pc.list_value_length(batch.column(1)), components))
        for at in range(0, batch.num_rows, block):
            part = batch.slice(at, block)
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)  # null is NaN
            good = np.isfinite(x).all(axis=1)
            x, ids = x[good], part.column(0).filter(pa.array(good))
            if not len(x):
                continue
            with np.errstate(over="ignore"):
                x = np.floor(x * SCALE)
            if np.abs(x).max() > LIMIT:
                raise ValueError(f"a component exceeds {LIMIT} after scaling by {SCALE}")
            x = x.astype("<i4")
            count = len(_columns(components, shards))
            lists = pa.array([ids.to_pylist()] + [None] * (count - 1), pa.list_(pa.int64()))
            cells = [np.ascontiguousarray(x[:, a:b]).tobytes() for a, b in _columns(components, shards)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * count, pa.int64()), pa.array([len(x)] * count, pa.int32()), lists, pa.array(cells, pa.binary()), pa.array(range(count), pa.int32())],
                names=["block", "n", "ids", "cells", "shard"],
            )
            number += 1


def _partial_distances(batches, slices: list[list[list[int]]]):
    import numpy as np
    import pyarrow as pa

    held = [np.array(s, np.int64) for s in slices]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            n, shard = row.column(1)[0].as_py(), row.column(4)[0].as_py()
            x = np.frombuffer(row.column(3)[0].as_py(), "<i4").reshape(n, -1).astype(np.int64)
            c = held[shard]
            # |x - c|^2 = |x|^2 - 2 x c + |c|^2
            if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= _DOUBLE_LIMIT:
                cross = (x.astype(float) @ c.T.astype(float)).astype(np.int64)
            else:
                cross = x @ c.T
            d = (x * x).sum(1)[:, None] - 2 * cross + (c * c).sum(1)
            wide = bool(d.max(initial=0) >= 1 << 32)
            yield pa.RecordBatch.from_arrays(
                [row.column(0), row.column(4), row.column(1), row.column(2), row.column(3), pa.array([wide]), pa.array([d.astype("<u8" if wide else "<u4").tobytes()], pa.binary())],
                names=["block", "shard", "n", "ids", "cells", "wide", "distances"],
            )


def _added(table):
    """Nearest centroid and distance of each vector of a block; ties go to the smaller number."""
    import numpy as np

    total = 0
    for wide, raw in zip(table["wide"].to_pylist(), table["distances"].to_pylist()):
        total = total + np.frombuffer(raw, "<u8" if wide else "<u4").astype(np.int64)
    total = total.reshape(table["n"][0].as_py(), -1)
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(len(nearest)), nearest]


def _cluster_sums(table):
    import numpy as np
    import pyarrow as pa

    nearest, _ = _added(table)
    order = np.argsort(nearest, kind="stable")
    clusters, starts, counts = np.unique(nearest[order], return_index=True, return_counts=True)
    out = []
    for shard, raw in zip(table["shard"].to_pylist(), table["cells"].to_pylist()):
        x = np.frombuffer(raw, "<i4").reshape(len(nearest), -1)[order].astype(np.int64)
        sums = np.add.reduceat(x, starts, axis=0)
        out += [{"shard": shard, "cluster": int(c), "n": int(n), "sums": s.tolist()} for c, n, s in zip(clusters, counts, sums)]
    return pa.Table.from_pylist(out, schema=pa.schema([("shard", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def _members(table):
    import pyarrow as pa

    nearest, distance = _added(table)
    ids = next(i for i in table["ids"].to_pylist() if i is not None)
    return pa.table({"vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(nearest, pa.int32()), "distance": pa.array(distance, pa.int64())})


class Clustering:
    """`members` has rows (vec_id, cluster, distance); `centroids` holds integer components."""

    def __init__(self, members: DataFrame, centroids: list[list[int]]):
        self.members, self.centroids = members, centroids


def lloyd(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, seed: int = 2, shards: int = SHARDS, block: int = BLOCK) -> Clustering:
    """Clusters `vectors` (vec_id, embedding), scaled to whole numbers, by a fixed number of rounds."""
    spark = vectors.sparkSession
    path = scratch_path(spark)
    plain = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    laid = plain.mapInArrow(partial(_laid_out, components=components, shards=shards, block=block), _LAYOUT)
    laid.write.partitionBy("shard").parquet(path)  # a file holds one shard's columns only
    stored = spark.read.schema(_LAYOUT).parquet(path)
    edges = _columns(components, shards)
    centroids = first_centroids(vectors, k, components, seed)

    def met():
        slices = [[c[a:b] for c in centroids] for a, b in edges]
        return stored.mapInArrow(partial(_partial_distances, slices=slices), _PARTIAL).groupBy("block")

    for _ in range(rounds if centroids else 0):
        sums = met().applyInArrow(_cluster_sums, "shard int, cluster int, n bigint, sums array<bigint>")
        cells = sums.select("shard", "cluster", "n", F.posexplode("sums").alias("at", "part"))
        totals = cells.groupBy("shard", "cluster", "at").agg(F.sum("part").alias("total"), F.sum("n").alias("n"))
        floor = F.expr("(total - pmod(total, n)) div n")
        moved = {(r["shard"], r["cluster"], r["at"]): r["x"] for r in totals.select("shard", "cluster", "at", floor.alias("x")).collect()}
        centroids = [
            [moved.get((s, c, i), old[a + i]) for s, (a, b) in enumerate(edges) for i in range(b - a)] for c, old in enumerate(centroids)
        ]
    return Clustering(met().applyInArrow(_members, "vec_id bigint, cluster int, distance bigint"), centroids)


def cluster_report(vectors: DataFrame, **how) -> DataFrame:
    """Every vector with its cluster's and the whole inertia and a digest of its centroid."""
    from tripmart.llm.common import Stored

    spark = vectors.sparkSession
    found = lloyd(vectors, **how)
    members = Stored(spark).put(found.members)
    # One row per centroid
    inertias = {r["cluster"]: r["s"] for r in members.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(c, inertias.get(c, 0), sum(inertias.values()), ",".join(map(str, x))) for c, x in enumerate(found.centroids)]
    facts = spark.createDataFrame(rows, "_cluster int, cluster_inertia bigint, inertia bigint, _components string")
    facts = facts.withColumn("centroid_sha256", F.sha2("_components", 256)).drop("_components")
    return members.join(F.broadcast(facts), F.col("cluster") == F.col("_cluster")).drop("_cluster")


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same result in SQL, round by round."""
    steps = [
        f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor({SCALE} * x)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {COMPONENTS} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v AS w
        FROM kept ORDER BY sha256('2:' || vec_id), v LIMIT {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
    a{i} AS MATERIALIZED (
        SELECT r, vec_id, v, min({{'d': list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c}}) AS m
        FROM kept, c{i} GROUP BY r, vec_id, v)"""
        )
        if i < rounds:
            steps.append(
                f"""
    s{i} AS MATERIALIZED (
        SELECT m.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, {COMPONENTS + 1})) AS i) GROUP BY m.c, i),
    c{i + 1} AS MATERIALIZED (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM s{i} GROUP BY c
        UNION ALL SELECT c, w FROM c{i} WHERE c NOT IN (SELECT c FROM s{i}))"""
            )
    last = f"""
    SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
        (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = m.c
    """
    return ",".join(steps) + last
