"""Cases that earlier versions answered wrongly."""

from __future__ import annotations

import gzip
import hashlib
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import minhash, substring_dedup, suffix_dedup, url_filter, warc
from clickmart.llm.common import told_apart
from clickmart.llm.warc import TASKS_PER_CORE
from clickmart.session import scratch_path
from tests.llm.test_small import by_id, docs, prose


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(b if bin(i).count("1") & 1 else a for i in range(n))


def test_words_that_share_polynomial_names(spark):
    one, other = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rest = prose(4, 34)
    got = by_id(substring_dedup.report(docs(spark, [f"{one} {rest}", f"{other} {rest}"])))
    assert [got[i]["n_removed"] for i in (0, 1)] == [0, 0]
    got = by_id(minhash.near_duplicates(docs(spark, [one, other])))
    assert [got[i]["component_id"] for i in (0, 1)] == [0, 1]


def test_texts_of_one_doc_id(spark):
    a, b = prose(5, 80), prose(6, 80)
    near = " ".join(a.split()[:-1])
    got = minhash.near_duplicates(docs(spark, [a, b, near, prose(7, 50)], [1, 2, 2, None])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (1, 1), (2, 1), (2, 1)]


def test_near_duplicates_of_long_texts(spark, monkeypatch):
    long = prose(8, 150_000, 9999)
    words = long.split()
    texts = [long, " ".join(words[:-5000]), " ".join(words[5000:]), prose(9, 150_000, 9999), *(prose(20 + i, 40) for i in range(3))]
    got = by_id(minhash.near_duplicates(docs(spark, texts)))
    assert len(long) > 600_000
    assert [got[i]["component_id"] for i in range(7)] == [0, 0, 0, 3, 4, 5, 6]


def test_members_are_dealt_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 500)
    parts = [prose(30 + i, 60) for i in range(6)]
    members = [(0, 2 * i + k, 2 * i + k, t) for i, p in enumerate(parts) for k, t in enumerate((p, p + " x"))]
    links = minhash.compare_members(spark.createDataFrame(members, "hub long, node long, comp long, text string"), minhash.Similarity())
    assert {tuple(sorted(r)) for r in links.collect()} == {(2 * i, 2 * i + 1) for i in range(6)}


def test_names_that_are_shared(spark):
    df = spark.createDataFrame([("aa",), ("bb",), ("bb",), ("cccc",), (None,)], "text string")
    name = told_apart(df, F.coalesce(F.length("text"), F.lit(0)).cast("long"), F.xxhash64("text"))
    got = [tuple(r) for r in df.select("text", name).collect()]
    assert len({n for _, n in got}) == 4 and len(set(got)) == 4 and ("cccc", 4) in got


@pytest.mark.parametrize("part_rules", [url_filter.PART_RULES, 1, 3])
def test_urls_with_line_ends(spark, part_rules):
    urls = ["http://evil.org/a.com\n/x", "http://evil.org/q.net\n/es/x", "http://h.org/x\n/wp-login.php", "http://a.net\n/es/x", "http://x.net/es/\n",
            "http://www.example.com/en/1", "http://example.com/en/1", "http://spam-farm.biz/", "", "://", "http://COM/", "http://com/" + "x" * 100_000, None]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 2)], "page_id long, url string").withColumns({"best": F.lit(1), "host": F.lit(2)})
    got = [(r["rule"], r["verdict"]) for r in url_filter.url_filter(pages, part_rules=part_rules).orderBy("page_id").collect()]
    assert got[:len(urls)] == got[len(urls):]
    assert got[:len(urls)] == [(None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("net/es/", "block"), ("www.example.com/en/", "allow"),
                               ("example.com/en/", "block"), (None, "block"), (None, "allow"), (None, "allow"), ("com/", "allow"), ("com/", "allow"), (None, "allow")]


def test_many_rules(spark):
    rules = tuple(url_filter.Rule("block" if i % 2 else "allow", f"h{i}.org", f"/p{i}") for i in range(100_000))
    pages = spark.createDataFrame([(i, f"http://h{i}.org/p{i}/x") for i in range(0, 100_000, 997)], "page_id long, url string")
    got = url_filter.url_filter(pages, rules=rules, part_rules=60_000).collect()
    assert {(r["rule"], r["verdict"]) for r in got} == {(f"h{i}.org/p{i}", "block" if i % 2 else "allow") for i in range(0, 100_000, 997)}


def foreign(kind: str, extra: str, block: str, version: str = "1.1") -> bytes:
    return f"WARC/{version}\r\nWARC-Type: {kind}\r\n{extra}Content-Length: {len(block.encode())}\r\n\r\n{block}\r\n\r\n".encode()


def test_archives_of_others(spark):
    http = "HTTP/1.1 200 OK\r\n\r\n<p>WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"
    payload = http.split("\r\n\r\n", 1)[1].encode()
    records = [foreign("warcinfo", "Content-Type: application/warc-fields\r\n", "software: x\r\n"),
               foreign("response", "WARC-Target-URI: http://a/\r\nContent-Type: application/http;msgtype=response\r\nWARC-Payload-Digest: sha1:ABC\r\n", http),
               foreign("revisit", "WARC-Target-URI:http://b/\r\nContent-Type: application/http\r\n", "HTTP/1.1 200 OK\r\n\r\n", "1.0")]
    path = tempfile.mkdtemp(prefix="foreign-")
    with open(f"{path}/a.warc", "wb") as f:
        f.write(b"".join(records))
    with open(f"{path}/b.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, records)))
    rows = warc.read_archives(spark, path, range_bytes=100).collect()
    for name in ("a.warc", "b.warc.gz"):
        got = {r["record_type"]: r for r in rows if r["file"].endswith(name)}
        assert got["response"]["payload_digest"] == hashlib.sha256(payload).hexdigest() and got["response"]["target_uri"] == "http://a/"
        assert got["warcinfo"]["payload_bytes"] == 13 and got["revisit"]["payload_digest"] is None and got["revisit"]["page_id"] is None
    assert len(rows) == 6
    with open(f"{path}/b.warc.gz", "ab") as f:
        f.write(gzip.compress(records[0])[:-9])
    with pytest.raises(Exception, match="breaks off"):
        warc.read_archives(spark, path).collect()


def test_many_ranges_in_few_tasks(spark):
    pages = spark.createDataFrame([(i % 5, f"http://a/{i}", f"<p>{i}</p>" * 60) for i in range(300)], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc-ranges", tempfile.mktemp()[-8:])
    warc.write_archives(pages.coalesce(1), path)
    out = warc.read_archives(spark, path, range_bytes=20)
    assert out.count() == 300 and out.rdd.getNumPartitions() <= TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    empty = scratch_path(spark, "test-warc-empty", tempfile.mktemp()[-8:])
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_repeated_rows_and_null_ids(spark):
    text = prose(50, 60)
    same = docs(spark, [text, text, text], [None, None, 4])
    assert {(r["n_removed"]) for r in substring_dedup.report(same).collect()} == {60}
    got = suffix_dedup.report(same).collect()
    assert sorted(r["n_removed"] for r in got) == [0, len(text.encode()), len(text.encode())]
    assert np.all([r["n_bytes"] == len(text.encode()) for r in got])
