"""Periodic runs against a brute-force search."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import periodic_runs
from clickmart.llm.common import table
from tests.llm.test_small import ODD, by_id, docs, prose

SF = "/root/testdata/sf0.001"


def brute(words: list[str]) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, least period)."""
    ids = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8)
        edge = np.diff(same)
        for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            if e + q - s >= max(6, 4 * q):
                found.setdefault((int(s), int(e + q)), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id: int, text: str | None) -> list[str]:
    words, h = (text or "").split(), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(words: list[str]) -> tuple:
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def lists(seed: int) -> list[list[int]]:
    """Texts made of repeated, nested and broken periods."""
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        words: list[int] = []
        while len(words) < rng.randint(1, 700):
            block = [rng.randint(0, rng.choice([1, 2, 9, 99])) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 13, 16, 31, 40, 64]))]
            block *= rng.choice([1, 1, 2, 3, 4, 5, 9])
            block = block * rng.choice([1, 1, 4, 6]) + block[:rng.randint(0, len(block))]
            if rng.random() < 0.2:
                block[rng.randrange(len(block))] = -1
            words += block
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    texts = [[str(w) for w in words] for words in lists(seed)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"]]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat = [w for t in texts for w in t]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    row, *runs = periodic_runs.runs_of(first, np.array([number[w] for w in flat]))
    got = [[] for _ in texts]
    for r, *run in zip(row, *runs, strict=True):
        got[r].append(tuple(int(x) for x in run))
    for t, g in zip(texts, got, strict=True):
        assert g == brute(t)


def test_contexts_are_chosen_alike():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 4, 200)
    seq = np.concatenate([rng.integers(0, 4, 77), part, rng.integers(0, 4, 50), part])
    names, scale = periodic_runs.mix(seq.astype(np.uint64)), 1
    while scale < 8:
        names, scale = periodic_runs._join(names[:-scale], names[scale:]), 2 * scale
    at = set(periodic_runs.synchronising(names, 8, np.zeros(len(names), bool)).tolist())
    assert {i for i in range(185) if 77 + i in at} == {i for i in range(185) if 327 + i in at}


def test_report_equals_brute_force(spark):
    got = periodic_runs.report(table(spark, SF, "documents")).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == expected(planted(r["doc_id"], texts[r["doc_id"]])), r["doc_id"]
    assert sum(r["n_runs"] > 0 for r in got) > 3


def test_odd_rows(spark):
    texts = [*ODD, "x y " * 5 + prose(3, 40), "    " * 9, ("p q r s t " * 30 + "z ") * 30]
    frame = docs(spark, texts)
    got = by_id(periodic_runs.report(frame))
    for i, t in enumerate(texts):
        words = [w for w in (t or "").replace(" ", "\x00").split()]
        words = [w.replace("\x00", " ") for w in planted(i, " ".join(words))]
        assert tuple(got[i])[1:] == expected(words), i
    full = by_id(periodic_runs.periodic_runs(frame))
    assert full[0]["runs"] == [] and full[0]["collapsed"] == "" and full[7]["collapsed"] == "a"
    twice = periodic_runs.report(frame.union(frame).withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id"))))
    assert twice.count() == 2 * len(texts) and twice.where("doc_id is null").count() == 8
    assert periodic_runs.report(docs(spark, [])).count() == 0
