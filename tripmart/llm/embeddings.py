"""Near-duplicate vectors of one label by sorted projection passes, then exact degrees.

1. Equal vectors of a label are one node. In every pass a node gets KEY_BITS signs: on which side of
   random hyperplanes through its label's mean direction it lies. Nodes are put in order of (label,
   dimension, concatenated signs): a range exchange and a sort. Each node is compared with the WINDOW nodes
   before it; the rows at the ends of neighbouring partitions are compared in a small second step. Verified
   pairs of all passes are united.
2. Each label has as many passes as its size and its spread call for. Both are measured: the mean of its
   unit vectors tells how far they lie from their centre, and so at what angle, seen from there, two
   vectors at the threshold stand. They come within a window of a label of n nodes if they share about
   log2(n / WINDOW) + 1 signs, and the passes leave them unseen in all passes with probability MISSED.
   The angle is taken as WIDEST at most. Labels so tight that it would be more (a mean cosine above 0.86
   at a threshold of 0.93) hold mostly linked vectors; a lone pair among them may be missed more often.
3. Links inside a component are then counted exactly. Members are put in shells by their angle to the
   component's mean direction. Two shells whose angles add up to less than the threshold's angle are
   linked throughout, two whose angles differ by more not at all; only other shells are compared, in
   blocks of bounded size. So a dense group of near copies costs a count and no pairs.

Defined results: a null label, and a vector that is null, empty, zero or holds a null or non-finite
component, links with nothing. Vectors of different length never link. Copies count as links.
Repeated rows (same vec_id and vector) link with each other like copies. component_id is the smallest
vec_id that is not null. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, components
from tripmart.operators.dimensions import broadcast_if_small

COSINE = 0.93
WINDOW = 64
KEY_BITS = 48
MISSED = 1e-6
WIDEST = math.pi / 3
#: Passes whose signs are taken at once.
AT_ONCE = 32
#: Shells per angle of the threshold, and rows of a block on average.
SHELLS = 16
BLOCK = 512


def _passes(n, spread, cosine: float, window: int, missed: float = MISSED):
    """Passes of a label of `n` nodes; `spread` is their mean squared distance from their centre."""
    apart = F.acos(F.greatest(F.lit(math.cos(WIDEST)), 1 - (1 - cosine) / F.greatest(spread, F.lit(1e-12))))
    signs = F.log2(F.greatest(n / window, F.lit(1.0))) + 1
    one = F.pow(1 - apart / math.pi, signs)
    return F.greatest(F.lit(4), F.ceil(math.log(missed) / F.log(1 - one))).cast("int")


def _centres(nodes: DataFrame, cosine: float, window: int) -> DataFrame:
    """Per label and dimension the mean of the unit vectors and the number of passes. One row per label."""
    unit = F.transform("vec", lambda x: x / F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, y: s + y * y)))
    cells = nodes.select("label", F.size("vec").alias("dim"), F.posexplode(unit).alias("at", "x"))
    means = cells.groupBy("label", "dim", "at").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    rows = means.groupBy("label", "dim").agg(
        F.array_sort(F.collect_list(F.struct("at", "x"))).alias("c"), F.first("n").alias("n"), (1 - F.sum(F.col("x") * F.col("x"))).alias("spread")
    )
    return rows.select(
        F.col("label").alias("_label"), F.col("dim").alias("_dim"), F.transform("c", lambda s: s["x"]).alias("centre"),
        _passes(F.col("n"), F.col("spread"), cosine, window).alias("passes"),
    )


def _matrix(column):
    import numpy as np

    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    ends = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _keyed(batches):
    """A row per node and pass with its sort key. Rows: (node, label, vec, centre, passes)."""
    import numpy as np
    import pyarrow as pa

    planes: dict = {}

    def signs(n: int, first: int):
        if (n, first) not in planes:
            planes[n, first] = np.random.default_rng([5, first]).standard_normal((n, AT_ONCE * KEY_BITS))
        return planes[n, first]

    weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
    names = ["pass", "label", "dim", "key", "node", "vec"]
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            part = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], names=part.schema.names)
            vectors, centres = _matrix(part.column(2)), _matrix(part.column(3))
            passes = part.column(4).to_numpy()
            sizes = np.array([len(v) for v in vectors])
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                x = np.stack([vectors[i] / np.linalg.norm(vectors[i]) - centres[i] for i in rows])
                for first in range(0, int(passes[rows].max()), AT_ONCE):
                    keys = (x @ signs(n, first) > 0).reshape(len(rows), AT_ONCE, KEY_BITS) @ weights
                    for k in range(AT_ONCE):
                        takes = passes[rows] > first + k
                        if takes.any():
                            own = part.take(pa.array(rows[takes]))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([first + k] * len(own), pa.int32()), own.column(1), pa.array([n] * len(own), pa.int32()), pa.array(keys[takes, k]), own.column(0), own.column(2)],
                                names=names,
                            )


def _compared(rows: list, fresh: int, window: int, cosine: float):
    """Links of the rows from `fresh` on with up to `window` rows before them. A row: (group, node, unit)."""
    import numpy as np

    out = []
    start = fresh
    while start < len(rows):
        end = start
        while end < len(rows) and end - start < 256 and rows[end][0] == rows[start][0]:
            end += 1
        low = max(0, start - window)
        while rows[low][0] != rows[start][0]:
            low += 1
        left, right = np.stack([r[2] for r in rows[start:end]]), np.stack([r[2] for r in rows[low:end]])
        near = left @ right.T >= cosine
        for i, j in np.argwhere(near):
            if 0 < start + i - (low + j) <= window:
                out.append((rows[start + i][1], rows[low + j][1]))
        start = end
    return out


def _rows(batch) -> list:
    import numpy as np

    columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("pass", "label", "dim", "node")]
    vectors = _matrix(batch.column(batch.schema.get_field_index("vec")))
    return [((p, l, d), n, v / np.linalg.norm(v)) for p, l, d, n, v in zip(*columns, vectors)]


def _windows(batches, window: int, cosine: float):
    """Links within a partition, and its first and last rows, with which partition and order they are."""
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("seam", pa.int32()), ("place", pa.int32()), ("pass", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("node", pa.binary()), ("vec", pa.list_(pa.float64()))])
    held: list = []
    first: list = []
    seen = 0

    def seam(rows, number, at):
        return [{"seam": number, "place": at + i, "pass": r[0][0], "label": r[0][1], "dim": r[0][2], "node": r[1], "vec": r[2]} for i, r in enumerate(rows)]

    for batch in batches:
        rows = held + _rows(batch)
        links = _compared(rows, len(held), window, cosine)
        if len(first) < window:
            first += rows[len(held) : len(held) + window - len(first)]
        seen += len(rows) - len(held)
        held = rows[-window:]
        if links:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], schema=schema)
    if seen:
        yield pa.RecordBatch.from_pylist(seam(first, part, window) + seam(held, part + 1, 0), schema=schema)


def _seams(batches, window: int, cosine: float):
    """Links across the ends of partitions; rows come in order of (seam, place)."""
    import pyarrow as pa

    rows, seam = [], None
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    for batch in batches:
        for number, row in zip(batch.column(batch.schema.get_field_index("seam")).to_pylist(), _rows(batch)):
            if number != seam:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in _compared(rows, 0, window, cosine)], schema=schema)
                rows, seam = [], number
            rows.append(row)
    yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in _compared(rows, 0, window, cosine)], schema=schema)


def _degrees(batches, cosine: float):
    """For blocks that lie together: how many vectors each left row is linked with."""
    import numpy as np
    import pyarrow as pa

    names = ("component", "u", "v", "ub", "vb", "left", "node", "copies")
    key, lefts, rights, out = None, [], [], ([], [])

    def finish():
        if lefts and rights:
            near = np.stack([x[1] for x in lefts]) @ np.stack([x[1] for x in rights]).T >= cosine
            own = np.array([x[0] for x in lefts], object)[:, None] == np.array([x[0] for x in rights], object)[None, :]
            counts = (near | own) @ np.array([x[2] for x in rights])
            out[0].extend(x[0] for x in lefts)
            out[1].extend(counts.tolist())

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
        for c, u, v, ub, vb, left, node, copies, vector in zip(*columns, _matrix(batch.column(batch.schema.get_field_index("vec")))):
            if (c, u, v, ub, vb) != key:
                finish()
                key, lefts, rights = (c, u, v, ub, vb), [], []
            (lefts if left else rights).append((node, vector / np.linalg.norm(vector), copies))
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64())], names=["node", "links"])
            out = ([], [])
    finish()
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64())], names=["node", "links"])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) of vectors (vec_id, embedding, label)."""
    stored = Stored(vectors.sparkSession)
    embedding = F.col("embedding").cast("array<double>")
    squares = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + x * x)
    sound = F.col("label").isNotNull() & F.coalesce((squares > 0) & (squares < float("inf")), F.lit(False))
    own = F.unhex(F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("string")).cast("binary")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), embedding.alias("vec"),
        F.when(sound, own).alias("node"),
    )
    rows = stored.put(rows)
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")
    )
    nodes = stored.put(nodes)
    edges = _links(nodes, stored, cosine, window)
    label = components(edges, stored)
    degrees = _exact_degrees(nodes.join(label, "node"), stored, cosine)
    named = nodes.select("node", "copies", "first_id").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    facts = named.join(smallest, "component").join(degrees, "node", "left").select(
        F.col("node").alias("_node"), (F.coalesce("links", "copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    placed = rows.select("vec_id", "node").join(facts, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return placed.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def _links(nodes: DataFrame, stored: Stored, cosine: float, window: int) -> DataFrame:
    """Verified pairs (a, b) of all passes."""
    centres = stored.put(_centres(nodes, cosine, window))
    met = (F.col("label") == F.col("_label")) & (F.size("vec") == F.col("_dim"))
    keyed = nodes.join(broadcast_if_small(centres), met).select("node", "label", "vec", "centre", "passes").mapInArrow(
        _keyed, "pass int, label string, dim int, key bigint, node binary, vec array<double>"
    )
    # Single precision in the exchange would change cosines, so doubles travel
    order = ["pass", "label", "dim", "key", "node"]
    found = stored.put(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            partial(_windows, window=window, cosine=cosine),
            "a binary, b binary, seam int, place int, pass int, label string, dim int, node binary, vec array<double>",
        )
    )
    ends = found.where(F.col("seam").isNotNull()).repartition("seam").sortWithinPartitions("seam", "place")
    across = ends.mapInArrow(partial(_seams, window=window, cosine=cosine), "a binary, b binary")
    return found.where(F.col("a").isNotNull()).select("a", "b").unionByName(across)


def _exact_degrees(members: DataFrame, stored: Stored, cosine: float) -> DataFrame:
    """Rows (node, links) of members (node, vec, copies, component): linked vectors, itself and copies included."""
    unit = F.transform("vec", lambda x: x / F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, y: s + y * y)))
    members = members.withColumn("unit", unit)
    sums = (
        members.select("component", F.posexplode("unit").alias("at", "x"))
        .groupBy("component", "at").agg(F.sum("x").alias("x"))
        .groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("c"))
        .select("component", F.transform("c", lambda s: s["x"]).alias("centre"))
    )
    theta = math.acos(cosine)
    dot = F.aggregate(F.zip_with("unit", "centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda s, x: s + x * x))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / F.greatest(length, F.lit(1e-300)))))
    shells = stored.put(
        members.join(sums, "component").select("node", "component", "vec", "copies", F.floor(angle / (theta / SHELLS)).cast("int").alias("u"))
    )
    sizes = shells.groupBy("component", "u").agg(F.sum("copies").alias("k"), F.count(F.lit(1)).alias("n"))
    other = sizes.select(F.col("component").alias("_c"), F.col("u").alias("v"), F.col("k").alias("vk"), F.col("n").alias("vn"))
    # At most a few hundred shells a component
    pairs = sizes.join(other, F.col("component") == F.col("_c")).drop("_c")
    pairs = stored.put(pairs.where(F.abs(F.col("u") - F.col("v")) - 1 < SHELLS))
    full = F.col("u") + F.col("v") + 2 <= SHELLS
    whole = pairs.where(full).groupBy("component", "u").agg(F.sum("vk").alias("links"))
    certain = shells.join(whole, ["component", "u"]).select("node", "links")
    part = pairs.where(~full).select(
        F.col("component").alias("_c"), F.col("u").alias("_u"), "v", F.ceil(F.col("n") / BLOCK).alias("us"), F.ceil(F.col("vn") / BLOCK).alias("vs")
    )
    columns = ["component", "u", "v", "ub", "vb", "left", "node", "copies", "vec"]
    own, every = F.xxhash64("node"), lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    lefts = shells.join(part, (F.col("component") == F.col("_c")) & (F.col("u") == F.col("_u"))).withColumn("ub", F.pmod(own, "us")).withColumn("vb", every("vs")).withColumn("left", F.lit(True)).select(*columns)
    rights = (
        shells.withColumnRenamed("u", "_v").join(part, (F.col("component") == F.col("_c")) & (F.col("_v") == F.col("v")))
        .withColumn("u", F.col("_u")).withColumn("vb", F.pmod(own, "vs")).withColumn("ub", every("us")).withColumn("left", F.lit(False)).select(*columns)
    )
    blocks = lefts.unionByName(rights).repartition("component", "u", "v", "ub", "vb").sortWithinPartitions("component", "u", "v", "ub", "vb")
    compared = blocks.mapInArrow(partial(_degrees, cosine=cosine), "node binary, links bigint")
    return certain.unionByName(compared).groupBy("node").agg(F.sum("links").alias("links"))
