"""A training corpus from raw documents: filter, deduplicate twice, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read back before
the next one runs, so a lost executor repeats tasks of one stage only. All but the last return the
columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import exact_dedup, minhash, mixing, packing, quality
from tripmart.llm.common import Stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return minhash.deduplicate(docs, shingle_words=5)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in a global random order."""
    return mixing.mix(docs).select(*[docs[c] for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_documents),
    ("minhash_near_dedup", without_near_copies),
    ("source_mixing", mixed_documents),
    ("best_fit_packing", packed_sequences),
]

#: The classifier's scores and token ids cannot be stated in SQL; tests compare stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Stored(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        following = stored.put(stage(spark, docs, sf_dir))
        stored.drop(docs)
        docs = following
    return docs
