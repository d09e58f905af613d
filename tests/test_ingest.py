"""Ingest (JSON lines, zip, missing hours, idempotence), streaming and pipeline."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from clickmart.plans import pipeline
from clickmart.plans.lake import Lake
from clickmart.sources import ingest, schemas
from clickmart.sources.feeds import feed_from_events
from clickmart.streaming.incremental import ingest_available
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
HOURS = [dt.datetime(2024, 1, 1, h) for h in range(0, 6)]


def _fmt(v):
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return v


def write_landing(spark, root, hours, feeds_subset=schemas.FEEDS):
    """One landing file per feed and hour (keys in reverse schema order), from
    the feeds derived from the small events table; returns rows written."""
    src = (spark.read.parquet(f"{SF}/events.parquet")
           .withColumn("_h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
           .where(F.col("_h").isin(list(hours))))
    written = {}
    for feed in feeds_subset:
        cols = [f.name for f in schemas.FEED_SCHEMAS[feed].fields]
        by_hour = {}
        for r in feed_from_events(src, feed, keep=("_h",)).collect():
            by_hour.setdefault(r["_h"], []).append(
                json.dumps({c: _fmt(r[c]) for c in reversed(cols)}))
        os.makedirs(f"{root}/data/{feed}", exist_ok=True)
        for h in hours:
            with open(ingest.landing_path(root, feed, h), "w") as f:
                f.write("".join(line + "\n" for line in by_hour.get(h, [])))
        written[feed] = sum(len(v) for v in by_hour.values())
    return written


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="clickmart-landing-")


def test_hour_addressing():
    h = dt.datetime(2024, 3, 5, 7)
    assert ingest.landing_path("/r", "geo_events", h) == "/r/data/geo_events/2024-3-05-H07.jsonl"
    assert ingest.source_path("/r", "geo_events", h) == \
        "/r/year=2024/month=3/day=05/hour=07/geo_events.jsonl.zip"


def test_json_by_name_extra_keys_and_broken_lines(spark, root):
    os.makedirs(f"{root}/data/browser_events")
    p = ingest.landing_path(root, "browser_events", HOURS[0])
    with open(p, "w") as f:
        f.write(json.dumps({"browser_name": "Chrome", "click_id": " ABC ", "event_id": "E1",
                            "event_timestamp": "2024-01-01 00:00:01.5", "junk": 1}) + "\n")
        f.write("{not json\n")
    df = ingest.read_json_feed(spark, p, "browser_events")
    got = df.select("event_id", "click_id", "browser_name", "event_timestamp", "load_hour",
                    F.col("_corrupt_record").isNotNull().alias("bad")).collect()
    good = [r for r in got if not r.bad]
    assert len(got) == 2 and len(good) == 1
    assert (good[0].event_id, good[0].click_id, good[0].browser_name) == ("e1", "abc", "Chrome")
    assert good[0].event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert good[0].load_hour == HOURS[0]
    rep = ingest.load_report(df, "browser_events").first()
    assert (rep.rows, rep.corrupt_rows) == (2, 1)


def test_ingest_missing_hour_and_idempotent_rerun(spark, root):
    spark.sql("DROP DATABASE IF EXISTS raw_t1 CASCADE")
    written = write_landing(spark, root, HOURS[:3])
    hours = HOURS[:4]                                   # hour 3 was never delivered
    rep = ingest.ingest_hours(spark, root, hours, db="raw_t1")
    skipped = [r for r in rep.collect() if r.status == "skipped"]
    assert {(r.feed, r.load_hour) for r in skipped} == {(f, HOURS[3]) for f in schemas.FEEDS}
    counts = {f: spark.table(f"raw_t1.{f}").count() for f in schemas.FEEDS}
    assert counts == written
    ingest.ingest_hours(spark, root, hours[:2], db="raw_t1")   # retry of two hours
    assert {f: spark.table(f"raw_t1.{f}").count() for f in schemas.FEEDS} == counts


def test_zipped_source_layout(spark, root):
    write_landing(spark, root, HOURS[:2], ["location_events"])
    for h in HOURS[:2]:
        src = ingest.landing_path(root, "location_events", h)
        dst = ingest.source_path(root, "location_events", h)
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        with zipfile.ZipFile(dst, "w") as z:
            z.write(src, arcname="location_events.jsonl")
    z = ingest.read_zipped_feed(spark, [ingest.source_path(root, "location_events", h) for h in HOURS[:2]],
                                "location_events")
    j = ingest.read_json_feed(spark, [ingest.landing_path(root, "location_events", h) for h in HOURS[:2]],
                              "location_events")
    cols = [f.name for f in schemas.LOCATION_EVENTS.fields] + ["load_hour"]
    assert rows(z.select(*cols)) == rows(j.select(*cols))


def test_streaming_available_now(spark, root):
    spark.sql("DROP DATABASE IF EXISTS raw_t2 CASCADE")
    written = write_landing(spark, root, HOURS[:2], ["geo_events"])
    ckpt = tempfile.mkdtemp(prefix="clickmart-stream-")
    ingest_available(spark, root, ["geo_events"], db="raw_t2", checkpoint_root=ckpt)
    assert spark.table("raw_t2.geo_events").count() == written["geo_events"]
    more = write_landing(spark, root, HOURS[2:3], ["geo_events"])
    ingest_available(spark, root, ["geo_events"], db="raw_t2", checkpoint_root=ckpt,
                     clean_source="delete")
    assert spark.table("raw_t2.geo_events").count() == written["geo_events"] + more["geo_events"]


def test_backfill_pipeline_equals_lazy_marts(spark, root):
    for db in ("raw", "stage", "mart"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    hours = ingest.hours_between(dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 2, 23))
    write_landing(spark, root, hours)
    pipeline.backfill(spark, root, hours[0], hours[-1])
    raw = ingest.read_raw(spark)
    expected = Lake(raw).marts
    stored = pipeline.load_marts(spark, cache=False)
    for name in pipeline.MART_TABLES:
        assert rows(stored[name]) == rows(expected[name].select(*stored[name].columns)), name
    listed = {(r.database, r.table) for r in ingest.catalog_listing(spark).collect()}
    assert ("mart", "top_performing_products") in listed and ("stage", "purchases") in listed


@pytest.mark.parametrize("layout", ["source", "zip"])
def test_ingest_hours_source_layouts(spark, root, layout):
    db = f"raw_{layout}"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    written = write_landing(spark, root, HOURS[:2], ["device_events"])
    for h in HOURS[:2]:
        src = ingest.landing_path(root, "device_events", h)
        dst = ingest.source_path(root, "device_events", h, zipped=(layout == "zip"))
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        if layout == "zip":
            with zipfile.ZipFile(dst, "w") as z:
                z.write(src, arcname="device_events.jsonl")
        else:
            with open(src) as a, open(dst, "w") as b:
                b.write(a.read())
    rep = ingest.ingest_hours(spark, root, HOURS[:3], layout=layout, db=db)
    stat = {(r.feed, r.load_hour): r.status for r in rep.collect()}
    assert stat[("device_events", HOURS[2])] == "skipped"
    assert stat[("device_events", HOURS[0])] == "loaded"
    t = spark.table(f"{db}.device_events")
    assert t.count() == written["device_events"]
    assert {r.load_hour for r in t.select("load_hour").distinct().collect()} <= set(HOURS[:2])


def test_zip_captures_corrupt_lines(spark, root):
    dst = ingest.source_path(root, "geo_events", HOURS[1])
    os.makedirs(os.path.dirname(dst), exist_ok=True)
    body = (json.dumps({"ip_address": "10.0.0.1", "click_id": "S1", "extra": True}) + "\n"
            + "{broken\n" + json.dumps({"click_id": "s2"}) + "\n")
    with zipfile.ZipFile(dst, "w") as z:
        z.writestr("geo.jsonl", body)
    df = ingest.read_zipped_feed(spark, dst, "geo_events").persist()
    got = sorted((r.click_id or "", r.ip_address or "", r._corrupt_record is not None, r.load_hour)
                 for r in df.collect())
    assert got == [("", "", True, HOURS[1]), ("s1", "10.0.0.1", False, HOURS[1]),
                   ("s2", "", False, HOURS[1])]
    rep = ingest.load_report(df, "geo_events").first()
    assert (rep.rows, rep.corrupt_rows) == (3, 1)
    df.unpersist()
