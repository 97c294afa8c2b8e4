"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most CAPACITY tokens. Pieces are numbered and cut into chunks of
CHUNK pieces, so a chunk is bounded whatever one document or source holds. A chunk is evolved on
ISLANDS tasks from different seeds: crossover puts whole well-filled bins of one parent into the
other, removes the bins that now hold something twice and best-fits what was displaced; mutation
empties the worst bins. Between EPOCHS an island's best packing migrates to the next island of its
chunk. An island stops when it has reached the least possible number of bins.

The worst-filled bins of every chunk are then opened, and their pieces, a twentieth of the chunk's at
most, form the chunks of the next level, until a level is one chunk. So the ends of chunks do not add
up to waste, and the levels shrink by ten times or more. Where an opened bin holds more pieces than
that, its small ones are joined into blocks of up to JOINED tokens, which are packed as one piece from
then on; a level that did not shrink to a half doubles JOINED. Whatever the lengths, levels end.

Defined results: null text is the empty text, which is its closing id alone. Repeated rows, null
doc_ids and equal lengths are packed as they come: every row has its own pieces. Empty tables give
empty results. Other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, with_place, with_rank
from tripmart.llm.tokens import encoded, encoder, tokenizer_path

CAPACITY = 4096
CHUNK = 4000
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
#: Share of a chunk's pieces that may go to the next level.
OPENED = 0.05
#: Tokens of a block of small pieces.
JOINED = 64
END_ID = 1
TOKENIZER = "word_bpe_49k.json"

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_MEMBERS = "array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_STATE = f"level int, chunk bigint, island int, items array<struct<length:bigint,members:{_MEMBERS}>>, bins array<int>"


def _pieces(batches, path: str, end_id: int, capacity: int):
    import zlib

    import pyarrow as pa

    encode = encoder(path).encode
    close = end_id.to_bytes(4, "little")
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), encode)):
            ids += close
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])


class _Bins:
    """An open packing: bins by free space, with a bit per free space that some bin has."""

    def __init__(self, capacity: int):
        self.capacity, self.by_space, self.present, self.bins = capacity, {}, 0, []

    def add(self, members: list[int], space: int) -> None:
        self.by_space.setdefault(space, []).append(len(self.bins))
        self.present |= 1 << space
        self.bins.append(members)

    def best_fit(self, item: int, length: int) -> None:
        fitting = self.present >> length
        if not fitting:
            self.add([item], self.capacity - length)
            return
        space = length + (fitting & -fitting).bit_length() - 1
        held = self.by_space[space]
        at = held.pop()
        if not held:
            self.present ^= 1 << space
        self.bins[at].append(item)
        left = space - length
        self.by_space.setdefault(left, []).append(at)
        self.present |= 1 << left


def _packed(kept: list[list[int]], loose, lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fits `loose`, longest first, around the bins that are kept."""
    state = _Bins(capacity)
    for members in kept:
        state.add(list(members), capacity - sum(lengths[i] for i in members))
    for item in sorted(loose, key=lengths.__getitem__, reverse=True):
        state.best_fit(item, lengths[item])
    return state.bins


def _fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> float:
    """Mean square of fillings: of two packings with as many bins the more uneven one is better."""
    return sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _crossed(one, other, lengths, capacity, draw):
    filled = sorted(other, key=lambda b: -sum(lengths[i] for i in b))
    injected = [b for b in filled[: max(1, len(filled) // 2)] if draw.random() < 0.5] or filled[:1]
    seen = {i for b in injected for i in b}
    kept, displaced = list(injected), []
    for members in one:
        if seen.isdisjoint(members):
            kept.append(members)
        else:
            displaced += [i for i in members if i not in seen]
    return _packed(kept, displaced, lengths, capacity)


def _mutated(bins, lengths, capacity, draw):
    """Empties the worst bins and a few others at random."""
    ordered = sorted(bins, key=lambda b: sum(lengths[i] for i in b))
    worst = max(1, len(bins) // 50)
    rest = ordered[worst:]
    chance = min(1.0, 2 * worst / max(1, len(rest)))
    kept, loose = [], [i for b in ordered[:worst] for i in b]
    for members in rest:
        if draw.random() < chance:
            loose += members
        else:
            kept.append(members)
    return _packed(kept, loose, lengths, capacity)


def evolve(lengths: list[int], seed: int, capacity: int = CAPACITY, elites=(), generations: int = GENERATIONS, population: int = POPULATION):
    """The best packing found: lists of item numbers. `elites` are packings to start from."""
    import random

    draw = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    people = [list(e) for e in elites] or [_packed([], range(len(lengths)), lengths, capacity)]
    if min(map(len, people)) > least:
        while len(people) < population:
            people.append(_mutated(people[0], lengths, capacity, draw))
        scored = [(len(p), -_fitness(p, lengths, capacity), n, p) for n, p in enumerate(people)]
        number = len(scored)
        for _ in range(generations):
            scored.sort()
            if scored[0][0] <= least:
                break
            one, other = draw.sample(scored[: max(2, population // 2)], 2)
            for child in (_crossed(one[3], other[3], lengths, capacity, draw), _mutated(scored[0][3], lengths, capacity, draw)):
                scored.append((len(child), -_fitness(child, lengths, capacity), number, child))
                number += 1
            scored = sorted(scored)[:population]
        people = [s[3] for s in sorted(scored)]
    return min(people, key=len)


def _bins_of(assigned: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for item, at in enumerate(assigned):
        bins.setdefault(at, []).append(item)
    return list(bins.values())


def _evolved(batches, capacity: int):
    """State rows in and out: one island of a chunk per row, with the elites to start from, if any."""
    import pyarrow as pa

    for batch in batches:
        assigned = []
        for level, chunk, island, items, elites in zip(*[batch.column(batch.schema.get_field_index(n)) for n in ("level", "chunk", "island", "items", "elites")]):
            lengths = items.values.field("length").to_pylist()
            starts = [_bins_of(e) for e in (elites.as_py() or [])]
            bins = evolve(lengths, 1000 * chunk.as_py() + 10 * level.as_py() + island.as_py() + len(starts), capacity, starts)
            places = [0] * len(lengths)
            for at, members in enumerate(bins):
                for item in members:
                    places[item] = at
            assigned.append(places)
        columns = [batch.column(batch.schema.get_field_index(n)) for n in ("level", "chunk", "island", "items")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(assigned, pa.list_(pa.int32()))], names=["level", "chunk", "island", "items", "bins"])


def _joined(items: list[dict], most: int) -> list[dict]:
    """Items of up to `most` tokens in blocks of up to `most`: no two blocks in turn would fit one."""
    out: list[dict] = []
    for item in sorted(items, key=lambda x: -x["length"]):
        if out and out[-1]["length"] + item["length"] <= most:
            out[-1] = {"length": out[-1]["length"] + item["length"], "members": out[-1]["members"] + item["members"]}
        else:
            out.append(item)
    return out


def _settled(batches, capacity: int, last: bool, joined: int = JOINED):
    """Bins of each chunk's best packing; `open` marks items for the next level (none if `last`).

    A row is a piece of a closed bin, or an open item with its members.
    """
    import pyarrow as pa

    piece = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema([*piece, ("open", pa.bool_()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("members", pa.list_(pa.struct(piece)))])
    for batch in batches:
        for level, chunk, items, bins in zip(*[batch.column(batch.schema.get_field_index(n)) for n in ("level", "chunk", "items", "bins")]):
            rows = items.as_py()
            packed = _bins_of(bins.as_py())
            packed.sort(key=lambda b: sum(rows[i]["length"] for i in b))
            may = int(OPENED * len(rows))
            out: list[dict] = []
            opening = not last
            for at, numbers in enumerate(packed):
                held = [rows[i] for i in numbers]
                if opening:
                    units = held if len(held) <= may else _joined(held, joined)
                    # The worst bin is always opened
                    opening = sum(x["length"] for x in held) < capacity and (at == 0 or len(units) <= may)
                if opening:
                    may -= len(units)
                    out += [x | {"open": True} for x in units]
                    continue
                sequence = (level.as_py() << 58) + (chunk.as_py() << 20) + at
                offset = 0
                for item in held:
                    for member in item["members"]:
                        out.append(member | {"open": False, "sequence_id": sequence, "offset": offset})
                        offset += member["length"]
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def token_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Rows of PIECE: the token ids of every text and the closing id, cut after `capacity` ids."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(partial(_pieces, path=path, end_id=end_id, capacity=capacity), PIECE)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, chunk: int = CHUNK) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    stored = Stored(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = token_pieces(docs, tokenizer, end_id, capacity).select("length", F.array(F.struct(*names)).alias("members"))
    pieces = stored.put(with_place(pieces))
    done = before = None
    level, joined = 0, JOINED
    # A chunk of one piece would be opened whole
    chunk = max(2, chunk)
    while True:
        count = pieces.count()
        last = count <= chunk
        # With blocks of a whole bin a chunk opens one item, or a twentieth of its own
        joined = min(capacity, 2 * joined) if before is not None and 2 * count > before else joined
        before = count
        numbered = with_rank(pieces).withColumn("chunk", F.floor(F.col("_rank") / chunk).cast("long"))
        states = numbered.groupBy("chunk").agg(F.collect_list(F.struct("length", "members")).alias("items"))
        states = states.select(
            F.lit(level).alias("level"), "chunk", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
            "items", F.lit(None).cast("array<array<int>>").alias("elites"),
        )
        # An island is a row; this spreads the islands of a chunk over tasks
        states = states.repartition("chunk", "island")
        evolved = None
        for epoch in range(EPOCHS):
            after = stored.put(states.mapInArrow(partial(_evolved, capacity=capacity), _STATE))
            stored.drop(evolved)
            evolved = after
            if epoch + 1 < EPOCHS:
                elite = evolved.select(
                    F.col("chunk").alias("_chunk"), ((F.col("island") + 1) % ISLANDS).alias("_island"), F.col("bins").alias("_bins")
                )
                met = (F.col("chunk") == F.col("_chunk")) & (F.col("island") == F.col("_island"))
                states = evolved.join(elite, met).select("level", "chunk", "island", "items", F.array("bins", "_bins").alias("elites"))
        best = evolved.groupBy("chunk").agg(
            F.min_by(F.struct("level", "chunk", "items", "bins"), F.struct(F.array_max("bins"), F.col("island"))).alias("s")
        ).select("s.*")
        settled = best.mapInArrow(
            partial(_settled, capacity=capacity, last=last, joined=joined), f"{PIECE}, open boolean, sequence_id bigint, offset bigint, members {_MEMBERS}"
        )
        settled = stored.put(settled)
        stored.drop(evolved)
        stored.drop(pieces)
        closed = settled.where("not open").select(*names, "sequence_id", "offset")
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done
        pieces = stored.put(with_place(settled.where("open").select("length", "members")))
        level += 1
