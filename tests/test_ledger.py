"""The ledger of deliveries, loads that parse once, drops in one statement, archives read as streams, the stream's retries."""

from __future__ import annotations

import datetime as dt
import io
import json
import os
import tempfile
import zipfile

import pyarrow as pa
import pytest

from clickmart.plans import pipeline
from clickmart.sources import ingest, ledger
from clickmart.streaming.incremental import ingest_available
from tests.test_deliveries import deliver, geo

HOURS = [dt.datetime(2024, 1, 1, h) for h in range(24)]


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="clickmart-ledger-")


def drop(spark, db):
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def name(hour):
    return f"2024-1-01-H{hour.hour:02d}.jsonl"


def test_backfill_loads_what_the_ledger_lacks(spark, root):
    drop(spark, "raw_l1")
    for h in HOURS[:3]:
        deliver(root, "geo_events", name(h), [geo(h.hour)])
    state = lambda: {(r.feed, r.load_hour.hour): r.state for r in ingest.ingest_pending(spark, root, HOURS[0], HOURS[3], db="raw_l1").collect()}
    first = state()
    assert [first["geo_events", h] for h in range(4)] == [ledger.NEW] * 3 + [ledger.MISSING] and first["device_events", 0] == ledger.MISSING
    deliver(root, "geo_events", name(HOURS[1]), [geo(7), geo(8), "{broken"])
    deliver(root, "geo_events", name(HOURS[3]), [])
    again = state()
    assert [again["geo_events", h] for h in range(4)] == [ledger.KEPT, ledger.CHANGED, ledger.KEPT, ledger.NEW]
    assert [state()["geo_events", h] for h in range(4)] == [ledger.KEPT] * 4
    assert sorted(r.click_id for r in spark.table("raw_l1.geo_events").collect()) == ["c0", "c2", "c7", "c8"]
    now = {r.load_hour.hour: r for r in ledger.current(spark, "raw_l1").where("feed = 'geo_events'").collect()}
    assert [(now[h]["rows"], now[h]["corrupt_rows"], now[h]["loads"]) for h in range(4)] == [(1, 0, 1), (3, 1, 2), (1, 0, 1), (0, 0, 1)]
    replaced = spark.table("raw_l1.replaced_keys").collect()
    assert [(r.feed, r.event_id, r.session_id) for r in replaced] == [("geo_events", None, "c1")]


def test_statements_do_not_grow_with_hours(spark, root, monkeypatch):
    drop(spark, "raw_l2")
    for h in HOURS:
        deliver(root, "geo_events", name(h), [geo(h.hour)])
    ingest.ingest_hours(spark, root, HOURS, db="raw_l2")
    for h in HOURS[:20]:
        deliver(root, "geo_events", name(h), [])
    said, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: said.append(q) or real(self, q, *a, **k))
    ingest.ingest_hours(spark, root, HOURS, db="raw_l2")
    assert sum("DROP IF EXISTS PARTITION" in q for q in said) == 1
    assert spark.table("raw_l2.geo_events").count() == 4


def test_input_is_parsed_once(spark, root, monkeypatch):
    drop(spark, "raw_l3")
    deliver(root, "geo_events", name(HOURS[0]), [geo(1), "{broken"])
    df = ingest.read_json_feed(spark, f"{root}/data/geo_events/*.jsonl", "geo_events")
    ingest.create_raw_tables(spark, "raw_l3")
    real = type(df.write).parquet

    def parquet(self, path, *a, **k):
        real(self, path, *a, **k)
        os.remove(f"{root}/data/geo_events/{name(HOURS[0])}")  # a second look at the input would fail

    monkeypatch.setattr(type(df.write), "parquet", parquet)
    counts = ingest.write_raw(df, "geo_events", "raw_l3")
    assert [(r["rows"], r["corrupt_rows"], r["parsed_rows"]) for r in counts] == [(2, 1, 1)]
    assert spark.table("raw_l3.geo_events").count() == spark.table("raw_l3.geo_events_rejected").count() == 1


def test_archive_of_more_than_two_gb(tmp_path):
    """One member of 2.2 GB, read in bounded batches without a copy of the archive or the member."""
    path, line, n = str(tmp_path / "big.jsonl.zip"), b"x" * (1 << 20) + b"\n", 2200
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("geo.jsonl", "w", force_zip64=True) as f:
        for _ in range(n):
            f.write(line)
    rows = largest = 0
    for batch in ingest._unzip_files(iter([pa.RecordBatch.from_pydict({"path": [path]})])):
        rows += batch.num_rows
        largest = max(largest, batch.nbytes)
    assert rows == n and largest < 3 * ingest.CHUNK_BYTES


def test_archives_of_other_stores_and_empty_ones(spark, root, monkeypatch):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("geo.jsonl", json.dumps(geo(1)) + "\n\n" + json.dumps(geo(2)))
    for hour, content in ((0, data.getvalue()), (1, zip_of_nothing())):
        path = ingest.source_path(root, "geo_events", HOURS[hour])
        os.makedirs(os.path.dirname(path))
        with open(path, "wb") as f:
            f.write(content)
    paths = [ingest.source_path(root, "geo_events", h) for h in HOURS[:2]]
    one = sorted(r.click_id for r in ingest.read_zipped_feed(spark, paths, "geo_events").collect())
    monkeypatch.setattr(ingest, "KNOWN_SCHEMES", ())
    assert one == sorted(r.click_id for r in ingest.read_zipped_feed(spark, paths, "geo_events").collect()) == ["c1", "c2"]


def zip_of_nothing() -> bytes:
    data = io.BytesIO()
    zipfile.ZipFile(data, "w").close()
    return data.getvalue()


def test_stream_runs_a_failed_batch_again(spark, root):
    drop(spark, "raw_l4")
    checkpoints = tempfile.mkdtemp(prefix="clickmart-ckpt-")
    deliver(root, "geo_events", name(HOURS[0]), [geo(1), geo(2)])

    def stop(feed, batch):
        raise RuntimeError("stopped after the table was written")

    with pytest.raises(Exception, match="stopped"):
        ingest_available(spark, root, ["geo_events"], "raw_l4", checkpoints, after_batch=stop)
    assert spark.table("raw_l4.geo_events").count() == 2
    deliver(root, "geo_events", name(HOURS[1]), [geo(3)])
    ingest_available(spark, root, ["geo_events"], "raw_l4", checkpoints)
    assert sorted(r.click_id for r in spark.table("raw_l4.geo_events").collect()) == ["c1", "c2", "c3"]
    now = {r.load_hour.hour: r.loads for r in ledger.current(spark, "raw_l4").collect()}
    assert now == {0: 2, 1: 1}
    assert {r.state for r in ingest.ingest_pending(spark, root, HOURS[0], HOURS[1], db="raw_l4").where("feed = 'geo_events'").collect()} == {ledger.KEPT}


def test_no_feed_folder(spark, root):
    assert ingest.feed_counts(spark, root).count() == 0


def test_cache_follows_a_refresh(spark):
    ingest.create_layers(spark, ["cached"])
    pipeline._save(spark.range(3), "cached.m")
    cache = pipeline.MartCache(spark, "cached")
    old = cache["m"]
    assert old.count() == 3 and cache["m"] is old and old.storageLevel.useMemory
    pipeline._save(spark.range(5), "cached.m")
    new = cache["m"]
    assert new.count() == 5 and new.storageLevel.useMemory and not old.storageLevel.useMemory
    cache.release("m")
    assert not new.storageLevel.useMemory
