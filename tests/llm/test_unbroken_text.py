"""A text without blanks is one word."""

from __future__ import annotations

import random

import sentencepiece

from clickmart.llm import sentencepieces
from tests.llm.test_small import docs


def test_sentencepieces_unbroken_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aabtheinon門é漢字ไทย") for _ in range(100_000)), "x" * 100_000]
    sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepieces.model_bytes())
    got = {r["doc_id"]: r["ids"] for r in sentencepieces.encode(docs(spark, texts)).collect()}
    assert [got[0], got[1]] == [sp.encode(t) for t in texts]
