"""Cases that other tests leave out: empty tables, repeated rows, null ids, hosts by hand, the pipeline on odd rows."""

from __future__ import annotations

import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickmart.llm import decontaminate, minhash, quality_rules, sentencepieces, substring_dedup, toxicity, warc
from clickmart.session import scratch_path
from tests.llm.test_small import DOCS, ODD, docs, prose

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def test_hosts_by_hand(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "few words"
    rows = [(i, bad if i < 9 else good, None, "poor", 0) for i in range(10)] + [(100 + i, good if i else bad, None, "fair", 0) for i in range(10)]
    rows += [(200, bad, None, None, 0), (201, good, None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    rules = quality_rules.HostRules()
    counts = quality_rules.document_counts(df, rules)
    hosts = {r["host"]: r for r in quality_rules.host_verdicts(counts, rules).collect()}
    assert {h: (r["n"], r["k"], r["host_rejected"]) for h, r in hosts.items()} == {"poor": (10, 9, True), "fair": (10, 1, False)}
    assert 0.1 < hosts["fair"]["host_rate"] < hosts["poor"]["host_rate"] < 0.9  # both are drawn to the mean of 0.5
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(df.union(df)).collect()}
    assert [kept[d] for d in (0, 9, 100, 101, 200, 201)] == [False, False, False, True, False, True]


def test_pages_that_share_an_id(spark):
    big = "x" * 200
    pages = spark.createDataFrame([(1, "a", big), (1, "b", big), (1, "c", "other " * 40), (2, "d", big)], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc-ids", tempfile.mktemp()[-8:])
    warc.write_archives(pages, path)
    got = sorted((r["target_uri"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, path).collect())
    assert got == [("a", "response", None), ("b", "response", None), ("c", "response", None), ("d", "revisit", 1)]


def test_decontaminate_empty_tables_and_long_items(spark):
    item = prose(5, 5000)
    bench = spark.createDataFrame([(1, item), (1, item), (None, item)], ITEMS)
    got = decontaminate.report(docs(spark, [item, item, None], [7, 7, None]), bench).collect()
    assert sorted((r["n_hit"], r["n_items"], r["items_sha256"]) for r in got)[1:] == [(5000, 1, hashlib.sha256(b"1").hexdigest())] * 2
    assert decontaminate.report(docs(spark, []), bench).count() == 0
    none = decontaminate.report(docs(spark, ["a b", ""]), bench.limit(0)).collect()
    assert [(r["n_hit"], r["contaminated"]) for r in none] == [(0, False)] * 2


@pytest.mark.parametrize("toxic", [0, 1])
def test_toxicity_of_one_class_and_odd_tables(spark, toxic):
    labels = spark.createDataFrame([(i, 1, toxic) for i in range(8)], LABELS)
    frame = docs(spark, [*ODD, "x"], [*range(8), None])
    assert {r["score"] for r in toxicity.report(frame.union(frame), labels).collect()} == {float(toxic)}
    assert toxicity.report(frame.union(frame), labels).count() == 2 * (len(ODD) + 1)
    assert toxicity.report(docs(spark, []), labels).count() == 0


def test_sentencepieces_empty_table_and_repeated_rows(spark):
    assert sentencepieces.report(docs(spark, [])).count() == 0
    got = sentencepieces.report(docs(spark, ["a b", "a b"], [1, 1])).collect()
    assert len(got) == 2 and got[0] == got[1]


def stages(spark, frame, labels, bench):
    """Every stage but the last keeps the columns, whatever they are."""
    for run in (lambda d: toxicity.remove_toxic(d, labels), minhash.keep_one, substring_dedup.remove_repeats,
                lambda d: decontaminate.decontaminate(d, bench)):
        frame = run(frame)
        yield frame


def test_pipeline_on_odd_rows(spark):
    item, copied = prose(70, 30), prose(71, 60)
    texts = [*ODD, copied, copied, copied + " more", "lead " + item, prose(72, 50), None]
    ids = [*range(len(texts) - 1), None]
    root = tempfile.mkdtemp(prefix="odd-")
    docs(spark, texts, ids).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, None, None), (None, 1, 1)], LABELS).withColumn("text", F.lit("x")).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], ITEMS).withColumn("doc_id", F.lit(0)).write.parquet(f"{root}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, root).collect()}
    # the later copies of a text, and the document of the benchmark item go; texts without words, and the null id, stay
    assert set(got) == {*ids} - {5, 9, 10, 11} and got[0]["ids"] is None and got[1]["ids"] == [] and got[8]["n_pieces"] > 60
    columns = docs(spark, []).columns
    for frame in stages(spark, docs(spark, []), spark.createDataFrame([], LABELS), spark.createDataFrame([], ITEMS)):
        assert frame.columns == columns and frame.count() == 0
