"""Passages that repeat across documents, by sparse suffix arrays.

1. Words are hashed. Of every WINDOW consecutive runs of GRAM words the least hashed one is a minimiser;
   only suffixes that start at minimisers are kept, about 2 / (WINDOW + 1) of all. Two copies of a
   passage of LEAST words share a kept suffix that agrees in the next KEY = LEAST - WINDOW + 1 words.
2. Suffixes are sorted by hashes of their first KEY words and of the words after, by a range exchange,
   so copies of a frequent passage are spread over tasks. Neighbours from different documents that
   agree in KEY words are a candidate diagonal of two documents. Ends of partitions are compared in a
   second step.
3. Neighbours by hash need not share the longest passage, nor does the order see the words before a
   suffix. So where more than two kept suffixes agree in KEY words, each of their windows of LEAST
   words that starts up to WINDOW - 1 words before is hashed whole, and the windows are sorted and
   compared with their neighbours in the same way: every window that two documents share has a link.
4. Diagonals are grouped per pair of documents and extended left and right on the whole word sequences.
   Runs of LEAST words and more are the result, for both documents.

Every kept suffix or window is compared with its two neighbours, so a passage in thousands of documents
costs two comparisons a document and window, and not all pairs of them are named. Words are runs of characters other than 0x20 and 0x09-0x0D, in either case as
they are.

Defined results: null and short texts repeat nothing. Repeats within one document are not reported.
Repeated rows (equal doc_id and text) are one document. Rows without doc_id take part and are reported
with null. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, forget_worker_state
from tripmart.llm.words import run_hashes, run_sums, slices, string_bytes, word_hashes

LEAST = 50
GRAM = 10
WINDOW = 20

_PAIR = "a bigint, b bigint, diagonal int"


def minimisers(hashes, gram: int = GRAM, window: int = WINDOW):
    """Positions of a word sequence that every `window` consecutive runs of `gram` words select from.

    The leftmost least value of a window is taken, and kept while it stays in the window.
    """
    import numpy as np

    begin = np.arange(max(0, len(hashes) - gram + 1))
    return _selected(run_hashes(run_sums(hashes), begin, begin + gram), window)


def _selected(runs, window: int):
    """`minimisers`, of the hashes of all runs of words of a text."""
    import numpy as np

    if not len(runs):
        return np.empty(0, np.int64)
    if len(runs) <= window:
        return np.array([int(np.argmin(runs))])
    views = np.lib.stride_tricks.sliding_window_view(runs, window)
    chosen = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    # In a stretch of equal runs every window has a leftmost one of its own: keep one a window
    same = np.flatnonzero(runs[chosen[1:]] == runs[chosen[:-1]]) + 1 if len(chosen) > 1 else np.empty(0, np.int64)
    if len(same):
        keep = np.ones(len(chosen), bool)
        last = chosen[0]
        equal = set(same.tolist())
        for i in range(1, len(chosen)):
            final = i + 1 == len(chosen) or (i + 1) not in equal
            if i in equal and chosen[i] - last < window and not final:
                keep[i] = False
            else:
                last = chosen[i]
        chosen = chosen[keep]
    return chosen


def _suffixes(batches, least: int):
    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    forget_worker_state()
    key = least - WINDOW + 1
    for batch in batches:
        rows, keys, nexts, places = [], [], [], []
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for start, end in slices(batch.column(1)):
            raw, offsets = string_bytes(batch.column(1).slice(start, end - start))
            hashes, _, _, firsts = word_hashes(raw, offsets, lower=False)
            sums = run_sums(hashes)
            begin = np.arange(max(0, len(hashes) - GRAM + 1))
            grams = run_hashes(sums, begin, begin + GRAM)
            found = []
            for row in np.flatnonzero(np.diff(firsts) >= least).tolist():
                at = _selected(grams[firsts[row] : firsts[row + 1] - GRAM + 1], WINDOW)
                found.append((row, at[at + key <= firsts[row + 1] - firsts[row]]))
            if not found:
                continue
            at = np.concatenate([a for _, a in found])
            row = np.repeat([r for r, _ in found], [len(a) for _, a in found])
            head = firsts[row] + at + key
            rows.append(ids[start + row])
            keys.append(run_hashes(sums, head - key, head).view(np.int64))
            tail = run_hashes(sums, head, np.minimum(head + key, firsts[row + 1]))
            nexts.append((tail >> np.uint64(33)).astype(np.int32))
            places.append(at.astype(np.int32))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nexts, rows, places)], names=["head", "tail", "doc", "at"])


def _adjacent(head, doc, at, upto: int):
    """Diagonals between neighbouring blocks of one head and document; the first `upto` blocks."""
    import numpy as np

    cut = np.flatnonzero((head[1:] != head[:-1]) | (doc[1:] != doc[:-1])) + 1
    starts = np.concatenate([[0], cut])
    ends = np.concatenate([cut, [len(head)]])
    out = []
    for before, now in zip(range(0, upto - 1), range(1, upto)):
        if head[starts[before]] != head[starts[now]]:
            continue
        long, short = ends[now] - starts[now], ends[before] - starts[before]
        steps = np.arange(max(long, short))
        x = at[starts[now] + np.minimum(steps, long - 1)]
        y = at[starts[before] + np.minimum(steps, short - 1)]
        a, b = doc[starts[before]], doc[starts[now]]
        out.append((a, b, y - x) if a < b else (b, a, x - y))
    return starts, out


class _Frequent:
    """Rows of a sorted partition whose head stands in three rows or more, or at an end of the partition."""

    def __init__(self):
        self.rows, self.told, self.first = None, None, None

    def of(self, head, doc, at):
        import numpy as np

        if self.rows is None:
            self.first, rows, told = head[0], (head, doc, at), np.zeros(len(head), bool)
        else:
            rows = tuple(np.concatenate([h, n]) for h, n in zip(self.rows, (head, doc, at)))
            told = np.concatenate([self.told, np.zeros(len(head), bool)])
        often = rows[0] == self.first
        # Heads are sorted: equal ones two rows apart have an equal one between
        same = rows[0][2:] == rows[0][:-2]
        for k in range(3):
            often[k : k + len(same)] |= same
        new = often & ~told
        self.rows, self.told = tuple(r[-2:] for r in rows), (often | told)[-2:]
        return rows[1][new], rows[2][new]

    def last(self):
        new = (self.rows[0] == self.rows[0][-1]) & ~self.told
        return self.rows[1][new], self.rows[2][new]


def _windows(batches, least: int):
    """The windows of `least` words around frequent suffixes: hash, document and first word."""
    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    for batch in batches:
        texts, places = batch.column(batch.schema.get_field_index("text")), batch.column(batch.schema.get_field_index("ats"))
        docs = batch.column(batch.schema.get_field_index("doc")).to_numpy()
        for start, end in slices(texts):
            hashes, _, _, firsts = word_hashes(*string_bytes(texts.slice(start, end - start)), lower=False)
            sums = run_sums(hashes)
            # Every word before a kept suffix, within its text; a place is met once
            ats = places.slice(start, end - start)
            row = np.repeat(np.arange(end - start), ats.value_lengths().to_numpy())
            at = firsts[row] + ats.flatten().to_numpy(zero_copy_only=False)
            begin, row = (at[:, None] - np.arange(WINDOW)).ravel(), np.repeat(row, WINDOW)
            inside = (begin >= firsts[row]) & (begin + least <= firsts[row + 1])
            begin, once = np.unique(begin[inside], return_index=True)
            row = row[inside][once]
            key = run_hashes(sums, begin, begin + least).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(docs[start + row]), pa.array((begin - firsts[row]).astype(np.int32))], names=["head", "doc", "at"]
            )


def _pair_batch(found, extra=None):
    import numpy as np
    import pyarrow as pa

    n = [len(f[2]) for f in found]
    a = np.repeat(np.array([f[0] for f in found], np.int64), n) if found else np.empty(0, np.int64)
    b = np.repeat(np.array([f[1] for f in found], np.int64), n) if found else np.empty(0, np.int64)
    d = np.concatenate([f[2] for f in found]).astype(np.int32) if found else np.empty(0, np.int32)
    return [pa.array(a), pa.array(b), pa.array(d)]


def _neighbours(batches, often: bool):
    """Diagonals of a sorted partition, and its first and last block for the seams.

    With `often` also the rows of frequent heads, as (doc, at) without seam and pair.
    """
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["a", "b", "diagonal", "seam", "side", "head", "doc", "at"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    held = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int32))
    first = None
    frequent = _Frequent()

    def suffixes(doc, at):
        return pa.RecordBatch.from_arrays([*[pa.nulls(len(doc), k) for k in kinds[:6]], pa.array(doc), pa.array(at)], names=names)

    def pairs(found):
        cells = _pair_batch(found)
        return pa.RecordBatch.from_arrays([*cells, *[pa.nulls(len(cells[0]), k) for k in kinds[3:]]], names=names)

    def seam(rows, number, side):
        n = len(rows[0])
        return pa.RecordBatch.from_arrays(
            [*[pa.nulls(n, k) for k in kinds[:3]], pa.array([number] * n, pa.int32()), pa.array([side] * n, pa.int32()), *[pa.array(r) for r in rows]],
            names=names,
        )

    for batch in batches:
        if not len(batch):
            continue
        new = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("head", "doc", "at")]
        if often:
            yield suffixes(*frequent.of(*new))
        rows = tuple(np.concatenate([h, n]) for h, n in zip(held, new))
        cut = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        blocks = len(cut) + 1
        starts, found = _adjacent(*rows, upto=blocks - 1)
        if first is None and blocks > 1:
            first = tuple(r[: starts[1]] for r in rows)
        if found:
            yield pairs(found)
        held = tuple(r[starts[max(0, blocks - 2)] :] for r in rows)
    if len(held[0]):
        if often:
            yield suffixes(*frequent.last())
        starts, found = _adjacent(*held, upto=2 if len(np.unique(held[0])) > 1 or len(np.unique(held[1])) > 1 else 1)
        if found:
            yield pairs(found)
        last = tuple(r[starts[-1] :] for r in held)
        yield seam(first if first is not None else last, part, 1)
        yield seam(last, part + 1, 0)


def _seams(batches):
    """Diagonals across the ends of partitions; rows come by seam, last blocks before first ones."""
    import numpy as np
    import pyarrow as pa

    def link(rows):
        sides = [[r for r in rows if r[0] == s] for s in (0, 1)]
        if not all(sides) or sides[0][0][1] != sides[1][0][1] or sides[0][0][2] == sides[1][0][2]:
            return []
        columns = [np.array([r[k] for r in sides[0] + sides[1]]) for k in (1, 2, 3)]
        return _adjacent(*columns, upto=2)[1]

    rows, seam, found = [], None, []
    for batch in batches:
        for number, *row in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("seam", "side", "head", "doc", "at")]):
            if number != seam:
                found += link(rows)
                rows, seam = [], number
            rows.append(row)
    found += link(rows)
    yield pa.RecordBatch.from_arrays(_pair_batch(found), names=["a", "b", "diagonal"])


def _extended(batches, least: int):
    """Runs of `least` equal words on the diagonals of two texts, in words of each."""
    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    names = ["a", "b", "a_start", "b_start", "n_words"]
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        sides = []
        for column in ("a_text", "b_text"):
            texts = batch.column(batch.schema.get_field_index(column))
            words: list = []
            for start, end in slices(texts):
                hashes, _, _, firsts = word_hashes(*string_bytes(texts.slice(start, end - start)), lower=False)
                words += [hashes[firsts[r] : firsts[r + 1]] for r in range(end - start)]
            sides.append(words)
        keys = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "diagonals")]
        for a, b, diagonals, x, y in zip(*keys, *sides):
            for d in diagonals:
                low, high = max(0, d), min(len(x), len(y) + d)
                same = np.concatenate([[False], x[low:high] == y[low - d : high - d], [False]])
                turns = np.flatnonzero(same[1:] != same[:-1])
                for begin, end in turns.reshape(-1, 2):
                    if end - begin >= least:
                        for column, value in zip(out, (a, b, int(low + begin), int(low + begin - d), int(end - begin))):
                            column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)


def _sorted_neighbours(rows: DataFrame, order: list[str], stored: Stored, often: bool) -> DataFrame:
    return stored.put(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            partial(_neighbours, often=often), f"{_PAIR}, seam int, side int, head bigint, doc bigint, at int"
        )
    )


def _pairs(neighbours: DataFrame) -> DataFrame:
    """Diagonals within partitions and across their ends."""
    ends = neighbours.where("seam IS NOT NULL").repartition("seam").sortWithinPartitions("seam", "side")
    return neighbours.where("a IS NOT NULL").select("a", "b", "diagonal").unionByName(ends.mapInArrow(_seams, _PAIR))


def repeated_passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (doc_id, start_word, end_word, n_words, other_doc_id, other_start_word), words from 0, end exclusive."""
    stored = Stored(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text IS NOT NULL").withColumn("doc", F.xxhash64("doc_id", "text"))
    kept = stored.put(rows.select("doc", "text").mapInArrow(partial(_suffixes, least=least), "head bigint, tail int, doc bigint, at int"))
    neighbours = _sorted_neighbours(kept, ["head", "tail", "doc", "at"], stored, often=True)
    stored.drop(kept)
    pairs = _pairs(neighbours)
    # The pairs' documents, and the places of frequent suffixes in a document
    frequent = neighbours.where("a IS NULL AND seam IS NULL").select(F.col("doc").alias("_doc"), F.col("at").alias("_at"))
    wanted = frequent
    for side in ("a", "b"):
        wanted = wanted.unionByName(pairs.select(F.col(side).alias("_doc"), F.lit(None).cast("int").alias("_at")))
    wanted = wanted.groupBy("_doc").agg(F.collect_set("_at").alias("ats"))
    texts = stored.put(rows.join(wanted, F.col("doc") == F.col("_doc")).drop("_doc").dropDuplicates(["doc"]))
    windows = texts.where(F.size("ats") > 0).select("doc", "text", "ats")
    windows = stored.put(windows.mapInArrow(partial(_windows, least=least), "head bigint, doc bigint, at int"))
    same = _sorted_neighbours(windows, ["head", "doc", "at"], stored, often=False)
    stored.drop(windows)
    pairs = pairs.unionByName(_pairs(same))
    pairs = stored.put(pairs.groupBy("a", "b").agg(F.collect_set("diagonal").alias("diagonals")))
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("b_text"))
    runs = pairs.join(left, "a").join(right, "b").select("a", "b", "diagonals", "a_text", "b_text").mapInArrow(
        partial(_extended, least=least), "a bigint, b bigint, a_start int, b_start int, n_words int"
    )
    runs = stored.put(runs)
    one = runs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("a_start").alias("start_word"), F.col("b_start").alias("other_start_word"), "n_words")
    two = runs.select(F.col("b").alias("x"), F.col("a").alias("y"), F.col("b_start").alias("start_word"), F.col("a_start").alias("other_start_word"), "n_words")
    ids = texts.select("doc", "doc_id")
    named = one.unionByName(two).join(ids.select(F.col("doc").alias("x"), "doc_id"), "x").join(ids.select(F.col("doc").alias("y"), F.col("doc_id").alias("other_doc_id")), "y")
    return named.select("doc_id", "start_word", (F.col("start_word") + F.col("n_words")).alias("end_word"), "n_words", "other_doc_id", "other_start_word").distinct()
