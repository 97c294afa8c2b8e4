"""Near-duplicate documents by min-max hashing, with links confirmed on whole shingle sets.

1. A document becomes its set of two-word shingles (64-bit hashes). Of every permutation both the
   smallest and the largest value are kept: each agrees between two sets with their Jaccard
   similarity as probability, so PERMUTATIONS hash evaluations give twice as many signature values.
2. Equal sets are one node. Bands of ROWS signature values name buckets. Two sets of similarity 0.8
   share no bucket with probability (1 - 0.8 ** ROWS) ** BANDS, about 6e-5 for 6 x 32.
3. A bucket's leader is the member that shares most bucket places with others, which finds the centre
   of a group of near copies. All members are compared with it on whole sets: one comparison a member,
   joined, never gathered.
4. Members other than the leader that are now in one component need no more. In a bucket with several
   components, the members outside its largest one are strays: every stray is compared with all other
   members, in blocks of bounded size that hold whole sets. A block gives the links that connect
   components, fewer than it has members, so pairs are not emitted.
So every pair of a bucket is compared on whole sets or already connected.

Defined results: null or wordless texts have an empty set, link with nothing and keep their own
doc_id; a text of one word is the set of that word. A repeated row has the component of its copy and
the same flag. Rows of null doc_id take part; component_id is the smallest doc_id that is not null.
Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, components, forget_worker_state, free_names
from tripmart.llm.words import mix, slices, string_bytes, word_hashes

PERMUTATIONS = 96
ROWS = 6
BANDS = 2 * PERMUTATIONS // ROWS
SHINGLE_WORDS = 2
#: Percent of the union that the intersection must reach.
PERCENT = 80
#: Strays and partners that meet in one block, on average.
BLOCK_STRAYS = 256
BLOCK_PARTNERS = 1024


def _sets(batch, width: int):
    """Yields (row, sorted distinct shingle hashes) of an Arrow batch (key, text)."""
    import numpy as np

    column = batch.column(1)
    for start, end in slices(column):
        raw, offsets = string_bytes(column.slice(start, end - start))
        hashes, _, _, firsts = word_hashes(raw, offsets)
        step = np.uint64(0x9E3779B97F4A7C15)
        runs = hashes.copy()
        for k in range(1, width):
            runs[: len(runs) - k] = mix(runs[: len(runs) - k] * step + hashes[k:])
        for row in range(end - start):
            a, b = firsts[row], firsts[row + 1]
            n = b - a
            if n >= width:
                yield start + row, np.unique(runs[a : b - width + 1])
            elif n:  # the whole sequence is the only shingle
                whole = np.uint64(n)
                for h in hashes[a:b]:
                    whole = mix(np.array([whole * step + h]))[0]
                yield start + row, np.array([whole], dtype=np.uint64)
            else:
                yield start + row, np.empty(0, np.uint64)


def _signatures(batches, width: int, permutations: int, rows: int):
    import hashlib

    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    forget_worker_state()
    draw = np.random.default_rng(11)
    times = draw.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = draw.integers(0, 2**63, permutations, dtype=np.uint64)
    names = draw.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    # High halves of a multiply-add: two values that a band combines come from two permutations
    for batch in batches:
        counts = np.zeros(len(batch), np.int64)
        nodes: list = [None] * len(batch)
        keys: list = [None] * len(batch)
        for row, values in _sets(batch, width):
            counts[row] = len(values)
            if not len(values):
                continue
            nodes[row] = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
            low = np.full(permutations, 2**32 - 1, np.uint32)
            high = np.zeros(permutations, np.uint32)
            for at in range(0, len(values), 1024):
                part = values[at : at + 1024]
                hashed = ((part[None, :] * times[:, None] + plus[:, None]) >> np.uint64(32)).astype(np.uint32)
                np.minimum(low, hashed.min(axis=1), out=low)
                np.maximum(high, hashed.max(axis=1), out=high)
            signature = np.concatenate([low, high]).reshape(-1, rows).astype(np.uint64)
            band = mix((mix(signature + np.arange(1, len(signature) + 1, dtype=np.uint64)[:, None]) * names).sum(axis=1))
            keys[row] = band.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "row_key", "n_shingles", "node", "bands"],
        )


def _shingles(batches, width: int):
    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    for batch in batches:
        sets = [values.view(np.int64) for _, values in _sets(batch, width)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "items"])


def minhash_near_dedup(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of documents (doc_id, text)."""
    spark = docs.sparkSession
    stored = Stored(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = stored.put(
        texts.mapInArrow(
            partial(_signatures, width=shingle_words, permutations=permutations, rows=rows),
            "doc_id bigint, row_key bigint, n_shingles bigint, node binary, bands array<bigint>",
        )
    )
    # One node per distinct set; a document stands for it when its text is fetched again
    nodes = (
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        )
    )
    nodes = stored.put(nodes)
    keys = nodes.select("node", "n", F.posexplode("bands").alias("band", "key")).select(
        "node", "n", F.xxhash64("band", "key").alias("bucket")
    )
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = stored.put(keys.join(shared, "bucket"))
    edges = _resolve(members, texts, nodes, stored, shingle_words, percent)
    label = components(edges, stored)
    named = nodes.select("node", "doc_id").join(label, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    places = named.join(smallest, "component").select(F.col("node").alias("_node"), "component_id")
    placed = signed.select("doc_id", "n_shingles", "node").join(places, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _resolve(members, texts, nodes, stored: Stored, width: int, percent: int) -> DataFrame:
    """Edges (a, b) between nodes; see the module's third and fourth step."""
    chosen = stored.put(_whole_sets(texts, nodes, members.select("node").distinct(), width))
    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    leaders = members.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("l"))
    leaders = stored.put(leaders.select(F.col("bucket").alias("_bucket"), F.col("l.node").alias("lead"), F.col("l.n").alias("lead_n")))
    led = members.join(leaders, F.col("bucket") == F.col("_bucket")).where("node <> lead")
    near = 100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n")
    pairs = led.where(near).select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    left = chosen.select(F.col("node").alias("a"), F.col("items").alias("a_items"))
    right = chosen.select(F.col("node").alias("b"), F.col("items").alias("b_items"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - both
    stars = stored.put(pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b"))
    label = components(stars, stored)
    known = label.select(F.col("node").alias("_node"), "component")
    rest = stored.put(
        led.join(known, F.col("node") == F.col("_node"), "left").select(
            "bucket", "node", F.coalesce("component", "node").alias("component")
        )
    )
    main = (
        rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
        .groupBy("bucket").agg(F.max(F.struct("k", "component")).alias("m"), F.sum("k").alias("total"))
        .where("m.k < total")
        .select(
            F.col("bucket").alias("_bucket"), F.col("m.component").alias("main"),
            F.ceil((F.col("total") - F.col("m.k")) / BLOCK_STRAYS).alias("s"), F.ceil(F.col("total") / BLOCK_PARTNERS).alias("p"),
        )
    )
    open_ = rest.join(main, F.col("bucket") == F.col("_bucket")).withColumn("stray", F.col("component") != F.col("main"))
    filled = open_.join(chosen, "node")
    own, every = F.xxhash64("node"), lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["bucket", "sb", "pb", "stray", "node", "component", "items"]
    strays = filled.where("stray").withColumn("sb", F.pmod(own, "s")).withColumn("pb", every("p")).select(*columns)
    partners = filled.withColumn("pb", F.pmod(own, "p")).withColumn("sb", every("s")).withColumn("stray", F.lit(False)).select(*columns)
    blocks = strays.unionByName(partners).repartition("bucket", "sb", "pb").sortWithinPartitions("bucket", "sb", "pb", F.desc("stray"))
    found = blocks.mapInArrow(partial(_block_links, percent=percent), "a binary, b binary")
    return stored.put(label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found))


def _block_links(batches, percent: int):
    """Links that connect components, of blocks that lie together in the rows."""
    import numpy as np
    import pyarrow as pa

    def links(strays: list, partners: list) -> list[tuple[bytes, bytes]]:
        if not strays or not partners:
            return []
        values, place = np.unique(np.concatenate([x[2] for x in strays + partners]), return_inverse=True)
        sizes = np.array([len(x[2]) for x in strays + partners])
        row = np.repeat(np.arange(len(sizes)), sizes)
        n = len(strays)
        seen = np.zeros((2, len(values)), bool)
        seen[0, place[row < n]] = seen[1, place[row >= n]] = True
        common = seen[0] & seen[1]
        keep = common[place]
        column = (np.cumsum(common) - 1)[place[keep]]
        row = row[keep]
        both = np.zeros((n, len(partners)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for start in range(0, int(common.sum()), 2048):
            a, b = np.searchsorted(column, [start, start + 2048])
            cells = np.zeros((len(sizes), 2048), np.float32)
            cells[row[a:b], column[a:b] - start] = 1
            both += cells[:n] @ cells[n:].T
        union = sizes[:n, None] + sizes[None, n:] - both
        near = 100 * both.astype(np.int64) >= percent * union.astype(np.int64)
        root: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for i, j in np.argwhere(near):
            x, y = find(strays[i][1]), find(partners[j][1])
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((strays[i][0], partners[j][0]))
        return out

    key, sides, found = None, ([], []), []
    for batch in batches:
        rows = [batch.column(batch.schema.get_field_index(c)) for c in ("bucket", "sb", "pb", "stray", "node", "component")]
        items = batch.column(batch.schema.get_field_index("items"))
        values, ends = items.values.to_numpy(), items.offsets.to_numpy()
        for at, (bucket, sb, pb, stray, node, component) in enumerate(zip(*[c.to_pylist() for c in rows])):
            if (bucket, sb, pb) != key:
                found += links(*sides)
                key, sides = (bucket, sb, pb), ([], [])
            sides[0 if stray else 1].append((node, component, values[ends[at] : ends[at + 1]].copy()))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])
            found = []
    found += links(*sides)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _whole_sets(texts, nodes, wanted, width: int) -> DataFrame:
    keys = nodes.join(wanted, "node", "left_semi").select("node", F.col("row_key").alias("_key"))
    found = texts.join(keys, F.col("row_key") == F.col("_key")).select("node", "text").dropDuplicates(["node"])
    return found.mapInArrow(partial(_shingles, width=width), "node binary, items array<bigint>")


def deduplicate(docs: DataFrame, **parameters) -> DataFrame:
    """The rows whose document stays, with all their columns: one document of each component."""
    dropped = minhash_near_dedup(docs, **parameters).where(
        ~F.col("kept") & F.col("component_id").isNotNull() & F.col("doc_id").isNotNull()
    )
    (own_id,) = free_names(docs, "_llm_id")
    dropped = dropped.select(F.col("doc_id").alias(own_id)).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col(own_id), "left_anti")
