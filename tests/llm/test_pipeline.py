"""The pipeline's stages and the registered corpus queries."""

from __future__ import annotations

import os
from functools import partial

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import connect, difference
from tripmart.llm import minhash, quality, suffixes
from tripmart.llm.common import BATCH_BYTES, Stored, worker_state
from tripmart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").collect()}
    columns = docs.columns
    found = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.columns == columns
        found.append([(r.doc_id, r.text) for r in docs.collect()])
    ids = {i for i, _ in found[0]}
    assert len(ids & good) >= 0.97 * len(good) and len(ids & bad) <= 0.25 * len(bad)  # eleven bad labels here
    latest = {}
    for i, t in found[0]:
        latest[t] = max(i, latest.get(t, -1))
    assert sorted(found[1]) == sorted((i, t) for t, i in latest.items())

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    sets = {i: shingles(t) for i, t in found[1]}
    own = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        before = dict(own)
        for i, j in links:
            own[i] = own[j] = min(own[i], own[j])
        if own == before:
            break
    assert {i for i, _ in found[2]} == {i for i in own if own[i] == i}
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR)
    assert packed.where("piece = 0").count() == len(found[3])


def test_batches_are_bounded_in_bytes(spark):
    """A partition of long texts is not one batch, in any session that an operator ran in."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    Stored(spark)
    texts = spark.range(40, numPartitions=1).selectExpr("id", "repeat('word ', 100000) AS text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([len(batch)]), "bytes": pa.array([batch.nbytes])})

    found = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r["rows"] for r in found) == 40
    assert max(r["bytes"] for r in found) <= 2 * BATCH_BYTES
    spark.conf.set(key, "1m")
    Stored(spark)
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)


@pytest.mark.parametrize("function", [quality._described, partial(minhash._signatures, width=2, permutations=6, rows=6), partial(suffixes._suffixes, least=50)])
def test_workers_forget_what_other_operators_remembered(function):
    worker_state()["encoders"] = {"path": object()}
    assert list(function(iter([]))) == []
    assert "encoders" not in worker_state()
