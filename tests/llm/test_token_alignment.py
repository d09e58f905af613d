"""Token alignment against a brute-force version over sets of ends."""

from __future__ import annotations

import hashlib
import random
from array import array
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmart.llm import token_alignment
from clickmart.llm.common import table
from tests.llm.test_small import ODD, docs

SF = "/root/testdata/sf0.001"
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def letters():
    """Byte of each letter of a byte-level vocabulary."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(extra)}


@pytest.fixture(scope="module")
def brute():
    import public_tokenizers

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = letters()

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        by_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        by_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(by_a) == b"".join(by_b) == (" " + text).encode():
            return []
        ends = [np.cumsum([len(x) for x in by]).tolist() for by in (by_a, by_b)]
        both = sorted({*ends[0]} & {*ends[1]})
        cut = [[0] + [e.index(x) + 1 for x in both] for e in ends] if len(both) < 3000 else [[0, *np.searchsorted(e, both) + 1] for e in ends]
        return [(ids_a[x:x2], ids_b[y:y2]) for x, x2, y, y2 in zip(cut[0], cut[0][1:], cut[1], cut[1][1:])]

    def run(texts):
        every = [groups(t) for t in texts]
        linked = [Counter((x, y) for g in own for x in g[0] for y in g[1]) for own in every]
        count = Counter(p for own in linked for p in own)
        top = Counter()
        for (x, _), n in count.items():
            top[x] = max(top[x], n)
        out = []
        for own, n in zip(every, linked, strict=True):
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
            out.append((sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), sum(n.values()),
                        sum(k for p, k in n.items() if count[p] == top[p[0]]), sum(k * count[p] for p, k in n.items()),
                        hashlib.sha256(said.encode()).hexdigest() if own else ""))
        return out

    return run


@pytest.mark.parametrize("seed", range(30))
def test_walk_finds_all_common_ends(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 5, 40, 3000])
    skip = rng.choice([0.0, 0.01, 0.3, 0.9])
    ends = [sorted({n} | {i for i in range(1, n) if rng.random() >= skip}) for _ in range(2)]
    both = sorted({*ends[0]} & {*ends[1]})
    got = token_alignment.aligned(*(array("q", e) for e in ends))
    for cuts, e in zip(got, ends, strict=True):
        assert [e[c - 1] for c in cuts] == both


def test_links_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    in_a, in_b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    a, b = rng.integers(0, 5, in_a.sum()), rng.integers(0, 5, in_b.sum())
    row = np.sort(rng.integers(0, 4, 60))
    whole = token_alignment.links(row, a, b, in_a, in_b, 7)
    monkeypatch.setattr(token_alignment, "LINKS", 10)
    for x, y in zip(whole, token_alignment.links(row, a, b, in_a, in_b, 7), strict=True):
        assert (x == y).all()
    assert whole[2].sum() == (in_a * in_b).sum()


@pytest.mark.parametrize("heavy", [token_alignment.HEAVY_PAIRS, 50])
def test_report_equals_brute_force(spark, brute, heavy):
    rows = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    got = token_alignment.report(rows, heavy_pairs=heavy).collect()
    for r, said in zip(sorted(got, key=lambda r: list(texts).index(r["doc_id"])), brute(texts.values()), strict=True):
        assert tuple(r[c] for c in FIGURES) == said, r["doc_id"]


def test_odd_rows(spark, brute):
    texts = [*ODD, "<|endoftext|> <s> </s> <unk> <0x41>", "猫は「\U0001f408」", "a\x00b\r\n\t  c", "ab" * 5000, " " * 999, "\U0001f468‍\U0001f469"]
    frame = docs(spark, texts)
    got = token_alignment.report(frame.union(frame.withColumn("doc_id", F.lit(None)))).collect()
    for r, said in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))[:len(texts)], brute([*texts, *texts]), strict=False):
        assert tuple(r[c] for c in FIGURES) == said, r["doc_id"]
    assert len(got) == 2 * len(texts) and token_alignment.report(docs(spark, [])).count() == 0


def test_lists(spark):
    r = token_alignment.align(docs(spark, ["Hello tokenizers", None])).orderBy("doc_id").collect()
    assert sum(r[0]["group_a"]) == len(r[0]["a"]) and sum(r[0]["group_b"]) == len(r[0]["b"]) and len(r[0]["group_a"]) == len(r[0]["group_b"]) > 0
    assert r[1]["a"] == r[1]["group_b"] == []
