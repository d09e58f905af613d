"""Toxicity: the work of the block-max index and of term counting, and examples without words."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from clickmart.llm import toxicity
from tests.llm.test_rare_words import labelled
from tests.llm.test_small import by_id, docs


def themed(rng, theme, n):
    """``n`` words, most of them of a theme."""
    return " ".join(f"w{theme if rng.random() < 0.9 else rng.randrange(24)}x{rng.randrange(100)}" for _ in range(n))


def test_most_blocks_are_skipped(spark, monkeypatch):
    rng = random.Random(5)
    texts = [themed(rng, i % 24, rng.choice((30, 60, 200))) for i in range(1536)]
    model = toxicity.fit(docs(spark, texts), labelled(spark, {i: i % 5 == 0 for i in range(len(texts))}))
    model.prepare()
    added = []
    add = toxicity.Model._add
    monkeypatch.setattr(toxicity.Model, "_add", lambda self, scores, often, blocks: (added.append(blocks.sum()), add(self, scores, often, blocks))[1])
    ask = model.vectors(pa.array([themed(rng, i % 24, 80) for i in range(240)]))
    found = model.nearest(ask)
    assert sum(added) < 0.4 * len(ask) * -(-len(model.ids) // toxicity.BLOCK_EXAMPLES)
    examples = [model.own(e) for e in range(len(model.ids))]
    dense = np.zeros((len(examples), len(model.weight)))
    for row, (terms, w) in zip(dense, examples, strict=True):
        row[terms] = w
    for (terms, w), near in zip(ask, found, strict=True):
        cosine = np.round(dense[:, terms] @ w, 9)
        best = np.lexsort((np.arange(len(cosine)), -cosine))[:toxicity.NEIGHBOURS]
        assert [e for _, e in near] == best.tolist()


def test_each_term_is_looked_up_once(monkeypatch):
    asked = []
    of = toxicity.Numbers.of
    monkeypatch.setattr(toxicity.Numbers, "of", lambda self, terms: (asked.extend(terms), of(self, terms))[1])
    texts = pa.array([f"unlikely{i} unlike{i} unli{i}" for i in range(50)])
    toxicity.term_counts(texts, toxicity.Numbers([b"unli*"]))
    assert len(asked) == len(set(asked))


@pytest.mark.parametrize("text", ["", "!? ..", None])
def test_examples_without_words(spark, text):
    got = by_id(toxicity.report(docs(spark, [text] * 8 + ["some words"]), labelled(spark, {i: i % 2 for i in range(8)})))
    assert len(got) == 9 and len({r["score"] for r in got.values()}) == 1
    assert 0 < got[8]["score"] < 1
