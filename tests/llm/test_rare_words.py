"""Toxicity by rare words, over full vectors and with few labels."""

from __future__ import annotations

import math
import random
from collections import Counter

import pyarrow as pa

from clickmart.llm import toxicity
from clickmart.llm.decontaminate import FOLD
from tests.llm.test_small import by_id, docs, prose


def plain_terms(text):
    words = text.encode().translate(FOLD).split()
    return Counter(words + [w[:k] + b"*" for w in words for k in (4, 5) if len(w) > k])


def labelled(spark, toxic):
    return spark.createDataFrame([(i, 1, int(t)) for i, t in toxic.items()], "doc_id long, quality int, toxic int")


def test_toxicity_rare_words_and_full_vectors(spark):
    rng = random.Random(3)
    texts = [prose(i, 40, 99) + (" vile wretch" if i % 3 == 0 else "") for i in range(300)]
    texts[0] = "zzyx qwop flurb snarv glorp drask venth"  # toxic by words of no other example
    texts += [texts[0], prose(7, 3000, 9999) + " vile", "", " ".join(rng.sample(texts[0].split(), 5)) + " unseen"]
    labels = {i: i % 3 == 0 for i in range(300)}
    df, lab = docs(spark, texts), labelled(spark, labels)
    got = by_id(toxicity.report(df, lab))
    assert got[300]["predicted"] == 1 and got[301]["predicted"] == 0
    model = toxicity.fit(df, lab)
    counts = {int(e): plain_terms(texts[e]) for e in model.ids}
    assert set(model.vocabulary) == {t for c in counts.values() for t in c}
    n = [sum(not labels[e] for e in counts), sum(labels[e] for e in counts)]
    held, seen = Counter(t for x in texts for t in plain_terms(x)), [Counter(), Counter()]
    for e, c in counts.items():
        seen[labels[e]].update(c.keys())

    def weight(t):
        clean, toxic = seen[0][t], seen[1][t]
        if not clean + toxic:
            return math.log((1 + len(texts)) / 2) + 1
        share = (clean + toxic) / sum(n)
        z = (toxic / n[1] - clean / n[0]) / math.sqrt(share * (1 - share + 1e-9) * (1 / n[0] + 1 / n[1]))
        return (math.log((1 + len(texts)) / (1 + held[t])) + 1) * max(z, 1)

    def vector(c):
        w = {t: (1 + math.log(k)) * weight(t) for t, k in c.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    vectors = [vector(counts[int(e)]) for e in model.ids]
    ask = [*texts[:40], *texts[300:]]
    for text, (_, near) in zip(ask, model.scores(pa.array(ask)), strict=True):
        own = vector(plain_terms(text))
        cosine = sorted(((sum(w * v.get(t, 0.0) for t, w in own.items()), -e) for e, v in enumerate(vectors)), reverse=True)
        want = [s for s, _ in cosine if s > 1e-12][:toxicity.NEIGHBOURS]
        assert len(near) == len(want) and all(abs(s - w) < 1e-8 for (s, _), w in zip(near, want, strict=True))


def test_toxicity_few_labels(spark):
    texts = [f"{'zzyx qwop flurb' if i % 2 else 'good calm plain'} {prose(i, 6)}" for i in range(24)] + ["zzyx qwop flurb", "good calm plain"]
    got = by_id(toxicity.report(docs(spark, texts), labelled(spark, {i: i % 2 for i in range(24)})))
    assert (got[24]["predicted"], got[25]["predicted"]) == (1, 0)
