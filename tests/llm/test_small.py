"""Each operator on small hand-made tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import tempfile
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

from clickmart.llm import (chat_format, decontaminate, minhash, quality_rules, sentencepieces, substring_dedup,
                           suffix_dedup, toxicity, url_filter, warc)
from clickmart.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["row", "t", "r", "names", "score", "n_words", "words", "bytes", "comp", "hits"]


def docs(spark, texts, ids=None):
    """Documents, with columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"s{(k % 2)}", 0 if t is None else len(t)) for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts, strict=True))]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(7) for c in CLASH})


def prose(seed, n, words=60):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, words)}" for _ in range(n))


LONG = prose(1, 30000)
ODD = [None, "", " \n\t", "one", LONG, LONG, "déjà vu \u2581 x", "a " * 200]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_rules(spark):
    got = by_id(quality_rules.quality_rules(docs(spark, [*ODD, "x y z\nx y z\n\n\n" + prose(2, 60, 9999)])))
    assert got[0]["n_words"] == got[1]["n_words"] == got[2]["n_words"] == 0 and got[0]["base_failed"]
    assert (got[7]["n_words"], got[7]["n_repeat_words"], got[7]["kept"]) == (200, 200, False)
    assert (got[8]["n_dup_lines"], got[8]["n_repeat_words"]) == (1, 6)
    assert quality_rules.quality_rules(docs(spark, [])).count() == 0


def test_warc_rejects_magic_in_payloads(spark):
    big = "x" * 150
    fake = "WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 40
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://b/ %\r\n", fake), (4, "u", None), (5, "u", ""), (6, "u", fake), (None, "u", big)]
    rows += [(100 + i, f"http://c/{i}", fake[:200] + str(i) * 5000) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = scratch_path(spark, "test-warc", tempfile.mktemp()[-8:])
    warc.write_archives(pages.coalesce(2), path)
    got = {r["page_id"]: r for r in warc.read_archives(spark, path, range_bytes=3000).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {p: r["refers_to"] for p, r in got.items() if r["record_type"] == "revisit"} == {2: 1, 6: 3, None: 1}
    assert got[3]["target_uri"] == "http://b/%20%25%0D%0A"


def brute_windows(texts, size):
    words = [(t or "").split() for t in texts]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - size + 1):
            seen.setdefault(tuple(w[i:i + size]), []).append((d, i))
    gone = [set() for _ in words]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + size))
    return words, gone


@pytest.mark.parametrize("seed", [0, 1])
def test_substring_dedup(spark, seed):
    rng = random.Random(seed)
    parts = [prose(100 + i, rng.randint(20, 60)) for i in range(6)] + ["a " * 50, "a b " * 40, "a b c " * 20]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + " " + prose(seed * 99 + i, 30) for i in range(30)] + ODD
    words, gone = brute_windows(texts, 35)
    got = by_id(substring_dedup.report(docs(spark, texts)))
    for i, w in enumerate(words):
        kept = " ".join(x for j, x in enumerate(w) if j not in gone[i])
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (
            len(w), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest()), i
    out = substring_dedup.remove_repeats(docs(spark, texts))
    assert out.columns == docs(spark, []).columns
    for i, r in by_id(out).items():
        assert (r["text"] or "").split() == [x for j, x in enumerate(words[i]) if j not in gone[i]]
        assert r["text"] == texts[i] or gone[i]
    assert substring_dedup.report(docs(spark, [])).count() == 0


def test_chat_format(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (2, 2, "user", "x"), (2, 2, "user", "x"),
            (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (3, 2, "user", "x"), (4, 0, "user", "hi"), (4, 1, "bot", None), (None, None, None, "q")]
    rows += [(5, i, "user", str(i)) for i in range(2500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1))
    got = {(r["conv_id"], r["part"]): r for r in chat_format.chat_format(df).collect()}
    assert {k[0] for k in got} == {2, 4, 5, None} and len([k for k in got if k[0] == 5]) == 40
    assert got[2, 0]["rendered"] == "<|user|>\nhi<|end|>\n<|bot|>\nyo<|end|>\n<|user|>\nx<|end|>\n"
    assert "".join(got[5, p]["rendered"] for p in range(40)) == "".join(f"<|user|>\n{i}<|end|>\n" for i in range(2500))
    assert chat_format.chat_format(df.limit(0)).count() == 0


def test_decontaminate_blocks_and_spans(spark):
    item = prose(5, 20)
    bench = spark.createDataFrame([(1, item), (2, "Short item!"), (3, None), (4, ""), (5, item)], "item_id long, text string")
    texts = [*ODD, f"Lead-in: {item.upper()}; end", prose(9, 900) + " " + item, "a short, ITEM b", item.rsplit(" ", 8)[0]]
    got = by_id(decontaminate.report(docs(spark, texts), bench))
    assert (got[8]["n_hit"], got[8]["n_items"], got[8]["contaminated"]) == (20, 2, True)
    assert (got[9]["n_hit"], got[9]["contaminated"]) == (20, False)
    assert got[10]["n_hit"] == 2 and got[11]["n_hit"] == 0 and got[0]["n_words"] == 0
    assert got[8]["items_sha256"] == hashlib.sha256(b"1,5").hexdigest()
    found = decontaminate.find(docs(spark, texts), bench, block_chars=2000)  # several blocks
    assert {r["doc_id"]: r["n"] for r in found.select("row.doc_id", F.size("hits").alias("n")).collect()} == {i: r["n_hit"] for i, r in got.items()}
    spans = {r["doc_id"]: texts[r["doc_id"]][r["start"]:r["end"]] for r in decontaminate.spans(found).collect()}
    assert spans[8] == item.upper() and spans[10] == "short, ITEM"
    assert decontaminate.decontaminate(docs(spark, texts), bench).columns == docs(spark, []).columns


def test_toxicity(spark):
    bad = ["vile", "scummy", "loathsome", "wretch"]
    rng = random.Random(4)
    texts = [prose(i, 50, 9999) + (" " + " ".join(rng.sample(bad, 3)) if i % 3 == 0 else "") for i in range(400)] + ODD
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(400)] + [(1, 1, None)], "doc_id long, quality int, toxic int")
    got = by_id(toxicity.report(docs(spark, texts), labels))
    for i in range(400):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["predicted"] == int(i % 3 == 0)
    assert got[400]["score"] == got[401]["score"] < 0.3
    none = toxicity.report(docs(spark, texts[:5]), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}


def test_neighbours_equal_exhaustive_search(spark):
    rng = random.Random(6)
    vocabulary = [f"tt{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 8))) for _ in range(500)]
    labels = spark.createDataFrame([(i, 1, int(rng.random() < 0.9 if "tt1" in t else rng.random() < 0.1)) for i, t in enumerate(texts)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(spark, texts), labels)
    vectors = dict(enumerate(model.vector(texts[i]) for i in model.ids))
    for text in texts[:60]:
        own, w = model.vector(text)
        all_ = [(sum(x * dict(zip(o, v.tolist())).get(t, 0.0) for t, x in zip(own, w.tolist())), e) for e, (o, v) in vectors.items()]
        want = sorted(((round(s, 9), -e) for s, e in all_ if s > 1e-12), reverse=True)[:toxicity.NEIGHBOURS]
        assert [(s, -e) for s, e in model.neighbours(own, w)] == want


def test_url_filter(spark):
    urls = [None, "nourl", "http://a.com", "http://a.com/", "https://www.Example.COM/en/x?q#f", "http://example.com/en/", "http://xexample.com/en/",
            "http://q.net/es/1", "http://net/es", "ftp://spam-farm.io/x", "x://y://b.net/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("h"))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.url_filter(pages).collect()}
    assert got == {0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("com/", "allow"), 4: ("www.example.com/en/", "allow"),
                   5: ("example.com/en/", "block"), 6: ("com/", "allow"), 7: ("net/es/", "block"), 8: (None, "allow"), 9: (None, "block"), 10: (None, "allow")}
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def brute_bytes(texts, size):
    seen, gone = {}, []
    for t in texts:
        raw, mine = (t or "").encode(), set()
        for i in range(len(raw) - size + 1):
            if raw[i:i + size] in seen:
                mine.update(range(i, i + size))
            seen[raw[i:i + size]] = 1
        gone.append((raw, mine))
    return gone


@pytest.mark.parametrize("many", [2048, 1])
def test_suffix_dedup(spark, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_CONTEXTS", many)  # 1: all contexts go by string digests
    rng = random.Random(8)
    parts = [prose(200 + i, rng.randint(20, 70)) for i in range(6)] + ["ab" * 90, "x" * 300, "é" * 120]
    texts = [rng.choice(parts)[rng.randint(0, 30):] + prose(i, 10) + rng.choice(parts)[:rng.randint(90, 400)] for i in range(40)] + ODD
    got = by_id(suffix_dedup.report(docs(spark, texts)))
    for i, (raw, gone) in enumerate(brute_bytes(texts, 100)):
        kept = bytes(b for j, b in enumerate(raw) if j not in gone)
        spans = sum(j - 1 not in gone for j in gone)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (
            len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()), i
    assert suffix_dedup.report(docs(spark, [])).count() == 0


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    comp = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    return [len(s) for s in sets], comp


def test_minhash(spark):
    rng = random.Random(11)
    texts = []
    for family in range(8):
        base = prose(300 + family, 80).split()
        for _ in range(15):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "zz" + str(rng.random())
            texts.append(" ".join(copy))
    texts += ["a b", "A B", "a b c d e", "a b c d e f", *ODD]
    size, comp = brute_components(texts, 4, 80)
    got = by_id(minhash.near_duplicates(docs(spark, texts), minhash.Similarity(4, 80)))
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == list(zip(size, comp))
    kept = minhash.keep_one(docs(spark, texts), minhash.Similarity(4, 80))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c in enumerate(comp) if i == c}
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_sentencepieces_equal_the_library(spark):
    rng = random.Random(12)
    texts = [*ODD, *("".join(rng.choice("aab theinon \n\r\té門;(){}.,") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepieces.model_bytes())
    tokens = sentencepieces.encode(docs(spark, texts))
    got = {r["doc_id"]: r["ids"] for r in tokens.collect()}
    assert all(got[i] == (None if t is None else sp.encode(t)) for i, t in enumerate(texts))
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(tokens).collect()}
    assert all(back[i] == (t and t.replace("\u2581", " ")) for i, t in enumerate(texts))
    report = by_id(sentencepieces.report(docs(spark, texts)))
    assert [i for i, r in report.items() if not r["round_trip"]] == [6]
