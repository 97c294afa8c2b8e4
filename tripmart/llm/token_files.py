"""Token ids in files of directly addressable codes.

Every id is split into chunks of CHUNK_BITS bits, the lowest first. Level 0 holds the lowest chunk of
every id, level 1 the next chunk of the ids that have one, and so on. A level has a bitmap that says
which of its ids go on, and a rank directory with the number of set bits before every block of
RANK_BITS bits. So the id at any position is found with one chunk, one bit and one directory entry per
level, without decoding a block.

A file is a Parquet folder of shards in ascending doc_id order; a shard is a row with the documents'
ids and first positions and, per level, chunks, bitmap and directory. Spark's writer commits them, so
a lost executor leaves no partial shard, and any file system Spark reads will do. Shards hold about
SHARD_IDS ids and are numbered by partition and place; a folder `parts` beside them holds the number of
ids before each partition.

Defined results: null text is the empty text: its end id alone. Null doc_ids come first. Rows of equal
doc_id are ordered by text, so repeated rows are equal either way. Empty tables give files without a
shard. Other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import scratch_path
from tripmart.llm.tokens import encoded, encoder, tokenizer_path

CHUNK_BITS = 8
RANK_BITS = 512
SHARD_IDS = 1 << 18
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"

_LEVEL = "struct<n:bigint,chunks:binary,more:binary,ranks:binary>"
SHARD = f"part int, number int, first_in_part bigint, n_ids bigint, doc_ids array<bigint>, starts array<bigint>, levels array<{_LEVEL}>"


def encode_levels(ids) -> list[dict]:
    """Directly addressable codes of an array of unsigned 32-bit ids."""
    import numpy as np

    rest = np.asarray(ids, dtype=np.uint32)
    levels = []
    while True:
        chunks = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint32(CHUNK_BITS)
        more = rest > 0
        sums = np.concatenate([[0], np.cumsum(more)])
        ranks = sums[np.arange(0, len(more) + 1, RANK_BITS)].astype("<u4")
        levels.append({"n": len(chunks), "chunks": chunks.tobytes(), "more": np.packbits(more, bitorder="little").tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more]
        if not len(rest):
            return levels


def decode_levels(levels: list[dict]):
    """All ids of a shard."""
    import numpy as np

    above = None
    for level in reversed(levels):
        ids = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if above is not None:
            more = np.unpackbits(np.frombuffer(level["more"], np.uint8), bitorder="little", count=level["n"]).astype(bool)
            ids[more] |= above << np.uint32(CHUNK_BITS)
        above = ids
    return above


def id_at(levels: list[dict], position: int) -> int:
    """One id, by its chunks, bits and directory entries alone."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][position] << shift
        more = level["more"]
        if not more[position >> 3] >> (position & 7) & 1:
            return value
        block = position // RANK_BITS
        rank = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        start = block * RANK_BITS // 8
        rank += (int.from_bytes(more[start : position >> 3], "little")).bit_count()
        rank += (more[position >> 3] & ((1 << (position & 7)) - 1)).bit_count()
        position, shift = rank, shift + CHUNK_BITS
    return value


def _shards(batches, path: str, end_id: int, shard_ids: int):
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    encode = encoder(path).encode
    close = end_id.to_bytes(4, "little")
    part = TaskContext.get().partitionId()
    level = pa.struct([("n", pa.int64()), ("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("first_in_part", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("levels", pa.list_(level))])
    number = before = size = 0
    docs, starts, held = [], [], []

    def shard():
        levels = encode_levels(np.frombuffer(b"".join(held), "<u4"))
        row = {"part": part, "number": number, "first_in_part": before, "n_ids": size, "doc_ids": docs, "starts": starts, "levels": levels}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), encode)):
            docs.append(doc_id)
            starts.append(size)
            held.append(ids + close)
            size += len(ids) // 4 + 1
            if size >= shard_ids:
                yield shard()
                number, before, size = number + 1, before + size, 0
                docs, starts, held = [], [], []
    if docs:
        yield shard()


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> str:
    """Write the ids of `docs` (doc_id, text) to a new folder `path` in ascending doc_id order."""
    file = tokenizer or tokenizer_path(TOKENIZER)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(partial(_shards, path=file, end_id=end_id, shard_ids=shard_ids), SHARD).write.parquet(f"{path}/shards")
    sizes = docs.sparkSession.read.parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sizes.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")).write.parquet(f"{path}/parts")
    return path


def open_shards(spark: SparkSession, path: str) -> DataFrame:
    """Rows of SHARD with `first`, the number of ids before the shard."""
    shards = spark.read.schema(SHARD).parquet(f"{path}/shards")
    parts = spark.read.schema("part int, n bigint, first bigint").parquet(f"{path}/parts").select(F.col("part").alias("_part"), F.col("first").alias("_first"))
    # A row per partition that was written
    joined = shards.join(F.broadcast(parts), F.col("part") == F.col("_part"))
    return joined.withColumn("first", F.col("_first") + F.col("first_in_part")).drop("_part", "_first")


def _documents(batches):
    import zlib

    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_levels(row["levels"])
            ends = [*row["starts"][1:], row["n_ids"]]
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["first"] + a for a in row["starts"]], pa.int64()),
                    pa.array([b - a for a, b in zip(row["starts"], ends)], pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(row["starts"], ends)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), from the files alone."""
    return open_shards(spark, path).mapInArrow(_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _looked_up(batches):
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        yield pa.RecordBatch.from_pydict(
            {"position": pa.array([r["position"] for r in rows], pa.int64()), "id": pa.array([id_at(r["levels"], r["position"] - r["first"]) for r in rows], pa.int64())}
        )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Rows (position, id) of global positions; a shard is decoded nowhere. Unknown positions give no row."""
    shards = open_shards(spark, path).select("part", "number", "first", "n_ids", "levels")
    # Positions meet shards by equal keys: the blocks of SHARD_IDS positions a shard touches
    touched = shards.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / SHARD_IDS), F.floor((F.col("first") + F.col("n_ids") - 1) / SHARD_IDS))))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn("_block", F.floor(F.col("position") / SHARD_IDS))
    met = asked.join(touched, (F.col("_block") == F.col("block")) & (F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_ids")))
    return met.select("position", "first", "levels").mapInArrow(_looked_up, "position bigint, id bigint")


def token_report(docs: DataFrame) -> DataFrame:
    """Writes `docs` to a new folder in the shared storage and reads it back."""
    spark = docs.sparkSession
    return read_documents(spark, write_tokens(docs, scratch_path(spark)))
