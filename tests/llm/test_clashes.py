"""Documents with columns named like the operators' own, and letters that are none."""

from __future__ import annotations

import pytest

from tripmart.llm import exact_dedup, language, minhash, mixing

OWN = ["_source", "_least", "_steps", "_times", "_replica", "_order", "_llm_id", "_llm_digest", "_llm_text", "_digest", "_Replica_"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(n, f"text number {n % 7} of the clashing documents", "en", "ab"[n % 2], n, *[f"{c}{n}" for c in OWN]) for n in range(20)]
    return spark.createDataFrame(rows, ", ".join(["doc_id bigint", "text string", "lang string", "source string", "n_chars bigint", *[f"{c} string" for c in OWN]]))


def test_mixing_keeps_clashing_columns(clashing):
    plain = mixing.mix(clashing.select("doc_id", "text", "source"))
    mixed = mixing.mix(clashing)
    assert mixed.columns[:-2] == clashing.columns and len({c.lower() for c in mixed.columns}) == len(mixed.columns)
    assert sorted((r[0], r[-2], r[-1]) for r in mixed.collect()) == sorted((r[0], r[-2], r[-1]) for r in plain.collect())
    assert all(r["_source"] == f"_source{r['doc_id']}" and r["_order"] == f"_order{r['doc_id']}" for r in mixed.collect())


@pytest.mark.parametrize("stage", [exact_dedup.deduplicate, minhash.deduplicate])
def test_stages_keep_clashing_columns(clashing, stage):
    kept = stage(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert 0 < len(rows) <= 7 and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in OWN)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in stage(clashing.select("doc_id", "text")).collect())


def test_numerals_are_no_letters(spark):
    texts = ["plain words of one language here", "½ ²", "Ⅷ 12", "中文", "", None]
    docs = spark.createDataFrame([(n, t, "en") for n, t in enumerate(texts * 3)], "doc_id bigint, text string, lang string")
    found = {r.doc_id % 6: r.lang_pred for r in language.identify(docs).collect()}
    assert [found[n] == "und" for n in (1, 2, 4, 5)] == [True] * 4 and found[0] == "en"
