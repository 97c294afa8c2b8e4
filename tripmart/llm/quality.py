"""Quality classifier: regularised quadratic discriminant over document statistics.

A document becomes FEATURES statistics, each transformed towards a bell shape (logarithms of counts,
log-odds of shares). Per class the mean and covariance come from summed moments of all labelled rows:
a few hundred numbers. A class covariance is shrunk towards the pooled one and that towards its
diagonal, so a statistic that never varies in a class stays usable. The score is the posterior of
class 1: a difference of log densities, by Mahalanobis distances through the Cholesky factors, which
are computed once at the fit.

Defined results: null text is the empty text and gets a score like any other. Rows with a null label
or without one are not learned from. With no rows of one class every score is the other's 0 or 1;
with no labelled row at all it is 0.5. Repeated rows are scored alike. Empty tables give empty
results. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Stored, forget_worker_state
from tripmart.llm.words import mix, slices, string_bytes, word_hashes

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "beyond_ascii",
    "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "line_words", "ended_words",
)
#: Share of the pooled covariance in a class covariance, and of the diagonal in the pooled one.
SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.05
#: Added to every variance, in transformed units.
FLOOR = 1e-3
THRESHOLD = 0.3


def _log_odds(share: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.log((share * n + 0.5) / ((1 - share) * n + 0.5))


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES per text, from the bytes of whole texts."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets).astype(float)
    hashes, begin, end, firsts = word_hashes(raw, offsets, lower=False)
    kinds = np.zeros(256, np.uint8)
    kinds[65:91] = 1
    kinds[48:58] = 2
    kinds[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 3  # marks of ordinary prose
    kinds[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 4
    kinds[128:192] = 5  # bytes inside a character
    kinds[192:] = 6
    kind = kinds[raw]

    def counted(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    characters = sizes - counted(kind == 5)
    words = np.diff(firsts).astype(float)
    line_ends = np.flatnonzero(raw == 10)
    lines_of = np.searchsorted(line_ends, offsets)
    lines = np.diff(lines_of) + 1.0
    ended = np.zeros(rows)
    if len(end):
        closes = np.isin(raw[end - 1], np.frombuffer(b".!?", np.uint8))
        sums = np.concatenate([[0], np.cumsum(closes)])
        ended = (sums[firsts[1:]] - sums[firsts[:-1]]).astype(float)
    distinct, top, pairs, distinct_lines = (np.zeros(rows) for _ in range(4))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + np.uint64(7)))])
    first_word_at = np.searchsorted(begin, line_ends)
    for row in range(rows):
        a, b = firsts[row], firsts[row + 1]
        if a == b:
            continue
        own = hashes[a:b]
        _, times = np.unique(own, return_counts=True)
        distinct[row], top[row] = len(times), times.max()
        pairs[row] = len(np.unique(own[:-1] * np.uint64(3) + own[1:])) if b - a > 1 else 1
        cuts = np.concatenate([[a], first_word_at[lines_of[row] : lines_of[row + 1]], [b]])
        distinct_lines[row] = len(np.unique(np.diff(sums[cuts])))
    many = np.maximum(words, 1)
    char = np.maximum(characters, 1)
    return np.column_stack([
        np.log1p(sizes), np.log1p(words), np.log1p(characters / many),
        _log_odds(counted(kind == 1) / char, char), _log_odds(counted(kind == 2) / char, char),
        _log_odds(counted(kind == 3) / char, char), _log_odds(counted(kind == 4) / char, char),
        _log_odds(counted(kind == 6) / char, char),
        _log_odds(distinct / many, many), _log_odds(top / many, many),
        _log_odds(pairs / np.maximum(many - 1, 1), np.maximum(many - 1, 1)),
        _log_odds(np.minimum(distinct_lines / lines, 1), lines),
        np.log1p(words / lines), _log_odds(ended / many, many),
    ])


def _described(batches):
    import pyarrow as pa

    np.seterr(over="ignore")
    forget_worker_state()
    for batch in batches:
        found = [np.empty((0, len(FEATURES)))]
        for start, end in slices(batch.column(1)):
            found.append(statistics(*string_bytes(batch.column(1).slice(start, end - start))))
        rows = list(np.concatenate(found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def describe(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x): the statistics of every document, in order."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _described, "doc_id bigint, x array<double>"
    )


@dataclass(frozen=True)
class Discriminant:
    """Prior log-odds of class 1, and per class the mean, the Cholesky factor's inverse, log det."""

    prior: float
    means: tuple
    factors: tuple
    log_dets: tuple

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.prior)))
        logs = []
        for mean, inverse, log_det in zip(self.means, self.factors, self.log_dets):
            away = (x - mean) @ inverse.T
            logs.append(-0.5 * ((away * away).sum(axis=1) + log_det))
        odds = np.clip(logs[1] - logs[0] + self.prior, -700, 700)
        return 1 / (1 + np.exp(-odds))


def _moments(batches):
    import pyarrow as pa

    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        x = np.array(batch.column(0).to_pylist(), dtype=float).reshape(len(batch), -1)
        for kind in (0, 1):
            own = x[label == kind]
            if len(own):
                # About zero is safe: transformed statistics are within a few tens
                sums = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pa.RecordBatch.from_pydict({"label": pa.array([kind] * len(sums), pa.int32()), "cell": pa.array(range(len(sums)), pa.int32()), "value": pa.array(sums)})


def fit(labelled: DataFrame) -> Discriminant:
    """From rows (x, label) with label 0 or 1. Only summed moments reach the driver."""
    sums = labelled.select("x", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    sums = sums.mapInArrow(_moments, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value"))
    k = len(FEATURES)
    table = np.zeros((2, 1 + k + k * k))
    for label, cell, value in sums.collect():
        table[label, cell] = value
    counts = table[:, 0]
    if not counts.all():
        return Discriminant(0.0 if not counts.any() else (700.0 if counts[1] else -700.0), (), (), ())
    means = [table[c, 1 : k + 1] / counts[c] for c in (0, 1)]
    scatter = [table[c, k + 1 :].reshape(k, k) - counts[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / counts.sum()
    pooled = (1 - SHRINK_TO_DIAGONAL) * pooled + SHRINK_TO_DIAGONAL * np.diag(np.diag(pooled))
    factors, log_dets = [], []
    for c in (0, 1):
        own = (1 - SHRINK_TO_POOLED) * scatter[c] / counts[c] + SHRINK_TO_POOLED * pooled + FLOOR * np.eye(k)
        root = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(root))
        log_dets.append(2 * float(np.log(np.diag(root)).sum()))
    return Discriminant(float(np.log(counts[1] / counts[0])), tuple(means), tuple(factors), tuple(log_dets))


def _scored(batches, model: Discriminant):
    import pyarrow as pa

    for batch in batches:
        x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(len(batch), -1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x) if len(x) else np.empty(0))], names=["doc_id", "score"])


def learnable(doc_id) -> F.Column:
    """False for the fifth of the ids that is held out (crc32 of the id as text)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted). `labels` has doc_id and quality."""
    stored = Stored(docs.sparkSession)
    described = stored.put(describe(docs))
    marks = labels.where(learnable("doc_id")).select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("label"))
    model = fit(described.join(marks, F.col("doc_id") == F.col("_id")))
    scored = described.mapInArrow(partial(_scored, model=model), "doc_id bigint, score double")
    held = F.coalesce(~learnable("doc_id"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted good, with all their columns. A row without doc_id is judged by its text."""
    stored = Stored(docs.sparkSession)
    described = stored.put(describe(docs))
    marks = labels.where(learnable("doc_id")).select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("label"))
    model = fit(described.join(marks, F.col("doc_id") == F.col("_id")))
    names = list(docs.columns)

    def judged(batches):
        import pyarrow as pa

        np.seterr(over="ignore")
        forget_worker_state()
        at = names.index("text")
        for batch in batches:
            scores = [np.empty(0)]
            for start, end in slices(batch.column(at)):
                scores.append(model.score(statistics(*string_bytes(batch.column(at).slice(start, end - start)))))
            yield batch.filter(pa.array(np.concatenate(scores) >= threshold))

    return docs.mapInArrow(judged, docs.schema)
