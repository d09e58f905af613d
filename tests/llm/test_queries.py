"""Registered queries against their SQL, and the pipeline against a brute-force version, on the smallest tables."""

from __future__ import annotations

import pytest
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline
from clickmart.llm import sentencepieces, toxicity
from clickmart.llm.common import table
from clickmart.llm.decontaminate import normal_words
from clickmart.llm.queries import ORACLE_SQL, REGISTRY
from tests.llm.test_small import brute_components, brute_windows
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)
    assert res[name].startswith("OK"), res[name]


def test_pipeline_matches_brute_force(spark):
    documents = table(spark, SF, "documents")
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    toxic = {r["doc_id"]: r["predicted"] for r in toxicity.report(documents, table(spark, SF, "labels")).collect()}
    left = sorted(d for d in text if not toxic[d])
    comp = brute_components([text[d] for d in left], 5, 80)[1]
    left = [d for i, d in enumerate(left) if comp[i] == i]
    words, gone = brute_windows([text[d] for d in left], 35)
    kept = {d: [w for j, w in enumerate(words[i]) if j not in gone[i]] for i, d in enumerate(left)}
    items = [w for r in table(spark, SF, "benchmark").collect() if (w := normal_words(r["text"]))]
    grams = {tuple(w[i:i + 13]) for w in items for i in range(max(1, len(w) - 12))}

    def clean(text):
        w, hit = normal_words(text), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
        return not hit or 20 * len(hit) < len(w)

    sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepieces.model_bytes())
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == {d for d in left if clean(" ".join(kept[d]))}
    for d, ids in got.items():
        assert sp.decode(ids).split() == kept[d]
        assert len(kept[d]) < len(text[d].split()) or ids == sp.encode(text[d])
