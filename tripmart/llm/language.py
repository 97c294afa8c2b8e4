"""Language identification by nearest centroids of normalised TF-IDF character n-grams.

Characters and runs of two and three of whole lower-cased texts are hashed into BUCKETS. Document
frequencies come from all documents learned from: one vector a task. A language has up to CENTROIDS
centroids, found by spherical k-means over about SAMPLE of its documents (chosen by a hash of text
and doc_id, so copies of a text are drawn one by one; this is the only sample, and its size is the parameter). A text gets the language of the centroid
of largest cosine. `rejected` marks texts farther from that centroid than nearly all of its own.

Defined results: a text that is null or has no letter is `und` with score 0 and rejected. With nothing
to learn from every text is. Documents of null lang are predicted, never learned from. Repeated rows are
predicted alike, ties go to the first language in order. Empty tables give empty results. Other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dimensions import broadcast_if_small

BUCKETS = 4096
CENTROIDS = 3
SAMPLE = 1000
ROUNDS = 8
#: A text is rejected below the cosine that this share of the sampled texts of its centroid exceeds, less MARGIN.
REJECTED_SHARE = 0.01
MARGIN = 0.1


def counts(text: str) -> np.ndarray:
    """Dampened n-gram counts of a whole text."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    run = points.copy()
    for n in range(3):
        if n:
            run = run[:-1] * np.uint32(0x9E3779B1) + points[n:]
        if not len(run):
            break
        total += np.bincount((run * np.uint32(0x85EBCA6B)) >> np.uint32(20), minlength=BUCKETS)
    return np.log1p(total)


def _texts(batch, column: int):
    for at in range(0, len(batch), 256):
        yield from batch.column(column).slice(at, 256).to_pylist()


def _frequencies(batches):
    import pyarrow as pa

    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in _texts(batch, 0):
            total += counts(text or "") > 0
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS + 1), pa.int32()), pa.array([*total.tolist(), n], pa.int64())], names=["bucket", "n"])


def _sampled(batches, weights: np.ndarray):
    import pyarrow as pa

    for batch in batches:
        rows = [_unit(counts(t or "") * weights).astype(np.float32) for t in _texts(batch, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["lang", "x"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(float(np.linalg.norm(x)), 1e-12)


def _clustered(table):
    """Spherical k-means of one language's sample, started from far apart texts."""
    import pyarrow as pa

    x = np.stack(table.column("x").to_numpy(zero_copy_only=False)) if len(table) else np.empty((0, BUCKETS))
    x = x[np.lexsort(x[:, :8].T)]  # the order of rows does not matter
    picked = [_unit(x.mean(axis=0))]
    while len(picked) < min(CENTROIDS, len(x)):
        picked.append(x[np.argmin(np.max(x @ np.stack(picked).T, axis=1))])
    centres = np.stack(picked)
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        centres = np.stack([_unit(x[own == k].mean(axis=0)) if (own == k).any() else centres[k] for k in range(len(centres))])
    own, best = np.argmax(x @ centres.T, axis=1), np.max(x @ centres.T, axis=1)
    floors = [float(np.quantile(best[own == k], REJECTED_SHARE)) - MARGIN if (own == k).any() else 0.0 for k in range(len(centres))]
    return pa.table({"lang": [table.column("lang")[0].as_py()] * len(centres), "centre": pa.array(list(centres.astype(np.float64)), pa.list_(pa.float64())), "floor": floors})


@dataclass(frozen=True)
class Centroids:
    weights: np.ndarray
    languages: tuple[str, ...]
    centres: np.ndarray
    floors: np.ndarray


def sample_of(learned: DataFrame) -> DataFrame:
    """About SAMPLE rows (lang, text) a language of rows (doc_id, text, lang)."""
    # A row per language; copied to the tasks after a check of its size, so texts are not moved
    sizes = broadcast_if_small(learned.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).select(F.col("lang").alias("_lang"), "_n"))
    drawn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return learned.join(sizes, F.col("lang") == F.col("_lang")).where(drawn * F.col("_n") < SAMPLE).select("lang", "text")


def fit(learned: DataFrame) -> Centroids | None:
    """From rows (doc_id, text, lang) with known languages. The driver gets the centroids and one vector of counts."""
    learned = learned.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").alias("lang")).where("lang IS NOT NULL")
    summed = learned.select("text").mapInArrow(_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect()
    if not summed:
        return None
    found = np.zeros(BUCKETS + 1)
    for bucket, n in summed:
        found[bucket] = n
    weights = np.log((1 + found[-1]) / (1 + found[:-1])) + 1
    sample = sample_of(learned)
    vectors = sample.mapInArrow(partial(_sampled, weights=weights), "lang string, x array<float>")
    rows = vectors.groupBy("lang").applyInArrow(_clustered, "lang string, centre array<double>, floor double").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["centre"]))
    if not rows:
        return None
    return Centroids(weights, tuple(r["lang"] for r in rows), np.array([r["centre"] for r in rows]), np.array([r["floor"] for r in rows]))


def _predicted(batches, model: Centroids | None):
    import pyarrow as pa

    for batch in batches:
        names, scores, rejected = [], [], []
        for text in _texts(batch, 1):
            if model is None or not text or not any(map(str.isalpha, text)):
                names.append("und")
                scores.append(0.0)
                rejected.append(True)
                continue
            near = model.centres @ _unit(counts(text) * model.weights)
            best = int(np.argmax(near))
            names.append(model.languages[best])
            scores.append(float(min(1.0, max(0.0, near[best]))))
            rejected.append(bool(near[best] < model.floors[best]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])


def held_out(doc_id: str) -> F.Column:
    """The quarter of the ids (crc32 of the id as text) that is not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score, rejected) of documents (doc_id, text, lang)."""
    model = fit(docs.where(~held_out("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(partial(_predicted, model=model), "doc_id bigint, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
