"""Language identification: vectors against a letter-by-letter version, accuracy on held-out rows, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import language_id as hd
from clickmart.llm.common import table
from tests.llm.test_small import ODD, by_id, docs


def brute_bundle(text: str) -> np.ndarray:
    words = "".join(c if hd._letters()[ord(c)] else " " for c in text.lower()).split()
    total = np.zeros(hd.DIMENSIONS, np.int64)
    for word in words:
        codes = [0, *map(ord, word), 0]
        for x, y, z in zip(codes, codes[1:], codes[2:]):
            total += np.roll(hd.signs(x), 2).astype(np.int64) * np.roll(hd.signs(y), 1) * hd.signs(z)
    return total


TEXTS = ["", "a", "Hello, WORLD 42 x", "ÄÖ-ß  İstanbul", "猫は猫", "...", "no\nlines\x00here " * 30, "\U0001f600 z"]


@pytest.mark.parametrize("held", [hd.TRIGRAMS, 5])
@pytest.mark.parametrize("dense", [hd.DENSE_LETTERS, 0])
def test_bundles_equal_brute_force(monkeypatch, held, dense):
    monkeypatch.setattr(hd, "TRIGRAMS", held)
    monkeypatch.setattr(hd, "DENSE_LETTERS", dense)
    monkeypatch.setattr(hd, "TEXTS", 3)
    row, gram = hd.trigrams(TEXTS)
    got = hd.bundles(row, gram, len(TEXTS))
    for text, bundle in zip(TEXTS, got, strict=True):
        assert (bundle == brute_bundle(text)).all(), text
    assert len(hd.trigrams([])[0]) == 0 and hd.bundles(*hd.trigrams([]), 0).shape == (0, hd.DIMENSIONS)


def test_letters_are_nearly_orthogonal():
    at = np.stack([hd.signs(c) for c in [0, *range(97, 123), *range(224, 256)]]).astype(np.int64)
    dots = at @ at.T / hd.DIMENSIONS
    assert (np.diag(dots) == 1).all() and abs(dots - np.eye(len(at))).max() < 0.2


def test_prototypes_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice(s) for _ in range(6)) for _ in range(rng.randint(1, 30))), lang)
            for i in range(40) for lang, s in (("x", "abcd"), ("y", "cdefg"))]
    got = hd.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7))
    assert got.languages == ["x", "y"]
    for lang, prototype in zip(got.languages, got.prototypes, strict=True):
        total = np.zeros(hd.DIMENSIONS)
        for _, text, own in rows:
            if own == lang:
                n = sum(map(len, text.split()))
                total += brute_bundle(text) * (hd.WEIGHT // n)
        assert np.allclose(prototype, total / np.linalg.norm(total), atol=1e-12)


def test_held_out_accuracy(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents")
    got = by_id(hd.report(rows))
    held = [r for r in rows.collect() if got[r["doc_id"]]["held_out"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert len(held) > 200 and right >= 0.99 * len(held)


def test_odd_rows(spark):
    texts = [*ODD, "123 ...", "z"]
    frame = docs(spark, texts)
    got = by_id(hd.report(frame))
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 8)] == ["und"] * 4 and got[0]["score"] == 0.0
    assert {got[i]["lang_pred"] for i in (3, 4, 5, 6, 7, 9)} == {"en"} and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[4]["score"] == got[5]["score"]
    unknown = hd.report(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    twice = hd.report(frame.union(frame.withColumn("doc_id", F.lit(None).cast("long"))))
    assert twice.count() == 2 * len(texts) and not twice.where("doc_id is null and held_out").count()
    assert hd.report(docs(spark, [])).count() == 0
    tie = spark.createDataFrame([(1, "abc", "b"), (3, "abc", "a")], "doc_id long, text string, lang string")
    assert hd.identify(tie, hd.learn(tie)).select("lang_pred").distinct().collect()[0][0] == "a"
