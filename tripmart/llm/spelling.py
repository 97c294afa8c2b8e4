"""Spelling variants by k-d trees over letter counts.

Words one edit apart have letter counts at most two apart in sum: a replaced letter takes one from one
count and adds one to another, an inserted one adds one to a count. So for the words of a length there is
a k-d tree over their letter counts, and a word asks the tree of its own length and that of the next
length, entering only boxes that such a change can reach. What it meets there is compared letter by letter.

The upper part of a tree deals the words to cells. It is built level by level: one pass counts, per open
cell and letter, how often each count occurs, all words included, and a cell of more than CELL words is cut
where its halves are most even. Words whose counts cannot be cut apart are dealt to several parts of their
cell, and whoever asks the cell asks all its parts. The driver holds one split per cell, a few bytes for
thousands of distinct words. A cell's words meet the words that ask it in one task, which holds the cell,
builds the lower part of the tree and lets the asking words stream past.

Letters are told apart by code point modulo 256. A clash only lets more words meet, so words of any
script are grouped right.

Defined results: null text has no words. A null doc_id is written as nothing in the hash that deletes
letters. Repeated rows count each time. Texts of any length are read whole. Tables without words give no
rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import string
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored

#: Words of one cell.
CELL = 16_384
#: Words of a box that is not cut any further.
LEAF = 32
LEAST_LETTERS = 5
LEAST_TIMES = 3
_LETTERS = 256
#: Pairs of words compared at once.
_PAIRS = 1 << 20

LINK = "word string, near string, near_n bigint"


def counted_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES) -> DataFrame:
    """Rows (word, n) of `docs` (doc_id, text): runs of Latin letters, A-Z in lower case, one in 97 with a letter deleted."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"), F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase).alias("t"))
    runs = texts.select("i", F.explode(F.expr(r"regexp_extract_all(t, '[a-z\\u00C0-\\u00FF]+', 0)")).alias("w"))
    # A run below the least length cannot become a word
    runs = runs.where(F.length("w") >= least_letters).withColumn("h", F.crc32(F.concat_ws(":", "i", "w").cast("binary")))
    at = "cast(h % length(w) as int)"
    cut = F.expr(f"concat(substring(w, 1, {at}), substring(w, {at} + 2))")
    words = runs.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("w")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_times)


def _codes(words: list[str], length: int):
    """Code points of words of one length, a row each."""
    import numpy as np

    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def _letter_counts(codes):
    import numpy as np

    out = np.zeros((len(codes), _LETTERS), np.uint8)
    rows = np.arange(len(codes))
    for column in codes.T:  # a word's letters one after another, so no row is met twice at once
        out[rows, column % _LETTERS] += 1
    return out


def _by_length(batch, column: int = 0):
    """(length, row numbers, words) of an Arrow batch."""
    import numpy as np

    words = batch.column(column).to_pylist()
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, [words[i] for i in rows]


class Tree:
    """The upper trees: `roots` by length; a node is a cell's number or (letter, most, left, right)."""

    def __init__(self):
        self.roots: dict[int, int] = {}
        self.nodes: list[tuple | None] = []  # None: a cell
        self.parts: dict[int, int] = {}

    def cell(self) -> int:
        self.nodes.append(None)
        return len(self.nodes) - 1

    def cells(self, length: int, counts):
        """(cell, row numbers) of words."""
        import numpy as np

        todo = [(self.roots[length], np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            if self.nodes[node] is None:
                yield node, rows
                continue
            letter, most, left, right = self.nodes[node]
            low = counts[rows, letter] <= most
            todo += [(child, part) for child, part in ((left, rows[low]), (right, rows[~low])) if len(part)]

    def reached(self, length: int, counts, replace: bool):
        """(cell, row numbers) of words that an edit may lead into a cell of words of `length`."""
        import numpy as np

        if length not in self.roots:
            return
        none = np.full(len(counts), -1, np.int16)
        todo = [(self.roots[length], np.arange(len(counts)), none, none)]
        while todo:
            node, rows, lost, won = todo.pop()
            if self.nodes[node] is None:
                yield node, rows
                continue
            letter, most, left, right = self.nodes[node]
            todo += _entered(letter, most, left, right, counts[rows, letter], rows, lost, won, replace)


def _entered(letter, most, left, right, own, rows, lost, won, replace: bool):
    """Both children of a box with the rows that can reach them, and the letters they must lose and win."""
    import numpy as np

    gap = own.astype(np.int16) - most
    out = []
    inside = gap <= 0
    loses = (gap == 1) & ((lost == -1) | (lost == letter)) if replace else np.zeros(len(gap), bool)
    pick = inside | loses
    if pick.any():
        out.append((left, rows[pick], np.where(loses, letter, lost)[pick].astype(np.int16), won[pick]))
    wins = (gap == 0) & ((won == -1) | (won == letter))
    pick = ~inside | wins
    if pick.any():
        out.append((right, rows[pick], lost[pick], np.where(wins, letter, won)[pick].astype(np.int16)))
    return out


def _histograms(batches, tree: Tree, wanted: set[int] | None):
    """Per cell and letter, how many words have each count; of the wanted cells, or of the lengths."""
    import numpy as np
    import pyarrow as pa

    held: dict[int, object] = {}
    for batch in batches:
        for length, _, words in _by_length(batch):
            counts = _letter_counts(_codes(words, length))
            for cell, rows in [(-length, slice(None))] if wanted is None else tree.cells(length, counts):
                if wanted is None or cell in wanted:
                    part = counts[rows]
                    top = max(int(part.max()) + 1, 2)
                    sums = np.stack([(part == c).sum(axis=0) for c in range(top)])
                    old = held.get(cell)
                    if old is not None and len(old) > len(sums):
                        old[: len(sums)] += sums
                    else:
                        if old is not None:
                            sums[: len(old)] += old
                        held[cell] = sums
    for cell, sums in held.items():
        often, letter = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array(np.full(len(letter), cell), pa.int32()),
                "letter": pa.array(letter, pa.int32()),
                "often": pa.array(often, pa.int32()),
                "words": pa.array(sums[often, letter], pa.int64()),
            }
        )


def build_tree(words: DataFrame, cell: int = CELL) -> Tree:
    """Upper trees over all of `words` (word, n). A pass over the words per level, one row per cell to the driver."""
    tree, wanted = Tree(), None
    while wanted is None or wanted:
        # The task gets a copy of the tree as it stands
        hist = words.select("word").mapInArrow(partial(_histograms, tree=tree, wanted=wanted), "cell int, letter int, often int, words bigint")
        hist = hist.groupBy("cell", "letter", "often").agg(F.sum("words").alias("words"))
        # A letter has a handful of different counts
        by_letter = hist.groupBy("cell", "letter").agg(F.sum("words").alias("size"), F.sort_array(F.collect_list(F.struct("often", "words"))).alias("steps"))
        cuts = by_letter.select("cell", "letter", "size", F.explode(F.expr("transform(steps, (s, i) -> struct(s.often as most, aggregate(slice(steps, 1, i + 1), 0L, (a, x) -> a + x.words) as low))")).alias("cut"))
        even = F.least(F.col("cut.low"), F.col("size") - F.col("cut.low"))
        best = F.struct(even.alias("even"), (-F.col("letter")).alias("letter"), F.col("cut.most").alias("most"))
        rows = cuts.groupBy("cell").agg(F.max("size").alias("size"), F.max(best).alias("best")).collect()
        following: set[int] = set()
        for row in sorted(rows, key=lambda r: r["cell"]):
            node = row["cell"]
            if wanted is None:
                node = tree.cell()
                tree.roots[-row["cell"]] = node
            if row["size"] > cell and row["best"]["even"] > 0:
                left, right = tree.cell(), tree.cell()
                tree.nodes[node] = (-row["best"]["letter"], row["best"]["most"], left, right)
                following |= {left, right}
            else:
                tree.parts[node] = -(-row["size"] // cell)
        wanted = following
    return tree


def _routed(batches, tree: Tree):
    """A row for each word in its cell (asks false) and for each cell part it asks."""
    import zlib

    import numpy as np
    import pyarrow as pa

    def rows(cells, parts, asks, batch, picked):
        part = batch.take(pa.array(picked))
        return pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(parts, pa.int32()), pa.array(np.full(len(picked), asks)), part.column(0), part.column(1)],
            names=["cell", "part", "asks", "word", "n"],
        )

    for batch in batches:
        for length, own, words in _by_length(batch):
            counts = _letter_counts(_codes(words, length))
            for cell, at in tree.cells(length, counts):
                parts = [zlib.crc32(words[i].encode()) % tree.parts[cell] for i in at]
                yield rows(np.full(len(at), cell), parts, False, batch, own[at])
            for other, replace in ((length, True), (length + 1, False)):
                for cell, at in tree.reached(other, counts, replace):
                    for part in range(tree.parts[cell]):
                        yield rows(np.full(len(at), cell), np.full(len(at), part), True, batch, own[at])


class Box:
    """The words of a cell and the k-d tree over them."""

    def __init__(self, words: list[str], ns):
        import numpy as np

        self.words, self.ns = np.array(words, object), ns
        self.length = len(words[0])
        self.codes = _codes(words, self.length)
        counts = _letter_counts(self.codes)
        self.letters = np.flatnonzero(counts.any(axis=0))
        self.marks = _marks(self.codes)
        self.root = self._cut(counts[:, self.letters], np.arange(len(words)))

    def _cut(self, counts, rows):
        """A row array, or (letter, most, left, right), cut where the halves are most even."""
        import numpy as np

        if len(rows) <= LEAF:
            return rows
        own = counts[rows]
        low = np.stack([(own <= c).sum(axis=0) for c in range(max(int(own.max()), 1))])
        even = np.minimum(low, len(rows) - low)
        most, letter = np.unravel_index(int(even.argmax()), even.shape)
        if not even[most, letter]:
            return rows
        left = own[:, letter] <= most
        return int(self.letters[letter]), int(most), self._cut(counts, rows[left]), self._cut(counts, rows[~left])

    def search(self, words: list[str], length: int):
        """(asking rows, own rows) of words one edit apart. Asking words have this length or one letter less."""
        import numpy as np

        codes = _codes(words, length)
        counts, marks = _letter_counts(codes), _marks(codes)
        replace = length == self.length
        none = np.full(len(words), -1, np.int16)
        todo, found = [(self.root, np.arange(len(words)), none, none)], []
        while todo:
            node, rows, lost, won = todo.pop()
            if isinstance(node, tuple):
                letter, most, left, right = node
                todo += _entered(letter, most, left, right, counts[rows, letter], rows, lost, won, replace)
                continue
            step = max(1, _PAIRS // len(rows))
            for at in range(0, len(node), step):
                own = node[at : at + step]
                # Letters that only one of both has: two at most after an edit
                apart = np.bitwise_count(marks[rows][:, None] ^ self.marks[own])
                q, t = np.nonzero(apart <= (2 if replace else 1))
                q, t = rows[q], own[t]
                if replace:
                    near = (codes[q] != self.codes[t]).sum(axis=1) == 1
                else:
                    near = _one_inserted(codes[q], self.codes[t])
                found.append((q[near], t[near]))
        if not found:
            return none[:0], none[:0]
        return np.concatenate([q for q, _ in found]), np.concatenate([t for _, t in found])


def _marks(codes):
    """A bit for every letter modulo 64 that a word holds."""
    import numpy as np

    return np.bitwise_or.reduce(np.uint64(1) << (codes % 64).astype(np.uint64), axis=1)


def _one_inserted(short, long):
    """Whether each long word is the short one with a letter put in: what fits from either end covers it."""
    import numpy as np

    front = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= short.shape[1]


def _searched(batches):
    """Links of all words that ask a cell, with rows sorted by cell, part and asks."""
    import numpy as np
    import pyarrow as pa

    key, words, ns, box = None, [], [], None
    for batch in batches:
        cells, parts, asks, counts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
        change = np.flatnonzero((cells[1:] != cells[:-1]) | (parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            if key != (cells[a], parts[a]):
                key, words, ns, box = (cells[a], parts[a]), [], [], None
            if not asks[a]:
                words += batch.column(3).slice(a, b - a).to_pylist()
                ns.append(counts[a:b])
                continue
            if not words:  # a part that holds nothing
                continue
            if box is None:
                box = Box(words, np.concatenate(ns))
            for length, rows, asking in _by_length(batch.slice(a, b - a), 3):
                q, t = box.search(asking, length)
                mine, theirs = np.array(asking, object)[q], box.words[t]
                pairs = [(mine, theirs, box.ns[t])]
                if length != box.length:
                    pairs.append((theirs, mine, counts[a:b][rows][q]))
                for word, near, n in pairs:
                    if len(word):
                        yield pa.RecordBatch.from_pydict({"word": pa.array(word, pa.string()), "near": pa.array(near, pa.string()), "near_n": pa.array(n, pa.int64())})


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """Rows of LINK, both ways, for every two of the distinct `words` (word, n) that are one edit apart."""
    tree = build_tree(words, cell)
    routed = words.select("word", "n").mapInArrow(partial(_routed, tree=tree), "cell int, part int, asks boolean, word string, n bigint")
    met = routed.repartition("cell", "part").sortWithinPartitions("cell", "part", "asks")
    return met.mapInArrow(_searched, LINK)


def roots(forms: DataFrame, stored: Stored) -> DataFrame:
    """Rows (word, root) of rows (word, form): every round follows a path twice as far.

    A form occurs at least twice as often as its word, so a path has no circle and fewer than 64 steps.
    """
    now = stored.put(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = now.join(further, F.col("root") == F.col("_word"), "left")
        new = stored.put(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        stored.drop(now)
        moved = new.where("moved").limit(1).count()
        now = new
        if not moved:
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of the words of `docs`."""
    stored = Stored(docs.sparkSession)
    words = stored.put(counted_words(docs))
    links = near_words(words, cell)
    # The most frequent near word, the first in code-point order among equals
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = near.select(F.col("word").alias("_word"), "n_near", F.col("best.word").alias("_form"), (-F.col("best.n")).alias("_form_n"))
    known = words.join(near, F.col("word") == F.col("_word"), "left")
    right = F.col("_form_n") >= 2 * F.col("n")
    known = stored.put(
        known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(right, F.col("_form")).alias("form"), F.when(right, F.col("_form_n")).alias("form_n"))
    )
    ends = roots(known.where("form is not null"), stored).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    joined = known.join(ends, F.col("word") == F.col("_word"), "left")
    return joined.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
    WITH RECURSIVE bits AS MATERIALIZED (
        SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
        FROM (SELECT unnest(range(256)) AS b)),
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w
        FROM documents),
    grouped AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY doc_id, w),
    spelled AS (SELECT *, hex(encode(doc_id || ':' || w)) AS x FROM grouped),
    hashed AS (
        SELECT w, n, xor(4294967295, list_reduce(list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
            lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]), 4294967295)) AS h
        FROM spelled, bits),
    cut AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word, n FROM hashed),
    words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM places),
    links AS (
        SELECT x.word, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
        UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word),
    ranked AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM links),
    forms AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1),
    paths AS (
        SELECT word, word AS root FROM forms
        UNION ALL
        SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n
    FROM forms f JOIN paths p ON p.word = f.word JOIN forms e ON e.word = p.root AND e.form IS NULL
"""
