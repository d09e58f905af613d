"""What a delivery may not lose: second files of an hour, empty redeliveries, bad lines, other column orders."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import pytest

from clickmart.sources import ingest, schemas
from clickmart.streaming.incremental import ingest_available
from clickmart.operators import report

HOUR = dt.datetime(2024, 1, 1, 5)


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="clickmart-deliveries-")


def deliver(root, feed, name, lines):
    os.makedirs(f"{root}/data/{feed}", exist_ok=True)
    with open(f"{root}/data/{feed}/{name}", "w") as f:
        f.write("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def geo(i):
    return {"click_id": f"c{i}", "geo_country": "DE"}


def test_two_files_of_one_hour_in_two_stream_runs(spark, root):
    spark.sql("DROP DATABASE IF EXISTS raw_d1 CASCADE")
    ckpt = tempfile.mkdtemp(prefix="clickmart-ckpt-")
    deliver(root, "geo_events", "2024-1-01-H05.jsonl", [geo(1), geo(2)])
    ingest_available(spark, root, ["geo_events"], db="raw_d1", checkpoint_root=ckpt)
    deliver(root, "geo_events", "late-2024-1-01-H05.jsonl", [geo(3)])
    deliver(root, "geo_events", "nameless.jsonl", [geo(4), "{broken"])
    ingest_available(spark, root, ["geo_events"], db="raw_d1", checkpoint_root=ckpt)
    assert sorted(r.click_id for r in spark.table("raw_d1.geo_events").collect()) == ["c1", "c2", "c3"]
    rejected = spark.table("raw_d1.geo_events_rejected").collect()
    assert sorted(r.reason for r in rejected) == ["no hour in the file name", "unreadable line"]


def test_empty_redelivery_and_bad_field(spark, root):
    spark.sql("DROP DATABASE IF EXISTS raw_d2 CASCADE")
    name = "2024-1-01-H05.jsonl"
    deliver(root, "device_events", name, [{"click_id": "a", "device_is_mobile": True}, {"click_id": "b", "device_is_mobile": "yes"}])
    got = {r.feed: r for r in ingest.ingest_hours(spark, root, [HOUR], db="raw_d2").collect()}
    r = got["device_events"]
    assert (r.status, r.rows, r.corrupt_rows) == ("loaded", 2, 1) and r.path.endswith(name) and r.size > 0
    assert got["geo_events"].status == "skipped"
    assert spark.table("raw_d2.device_events").count() == 1
    assert '"yes"' in spark.table("raw_d2.device_events_rejected").first().line
    deliver(root, "device_events", name, [])
    r = {r.feed: r for r in ingest.ingest_hours(spark, root, [HOUR], db="raw_d2").collect()}["device_events"]
    assert (r.status, r.rows) == ("loaded", 0)
    assert spark.table("raw_d2.device_events").count() == spark.table("raw_d2.device_events_rejected").count() == 0


def test_insert_by_name_into_another_column_order(spark, root):
    spark.sql("DROP DATABASE IF EXISTS raw_d3 CASCADE")
    spark.sql("CREATE DATABASE raw_d3")
    cols = [f"{f.name} {f.dataType.simpleString()}" for f in reversed(schemas.BROWSER_EVENTS.fields)]
    spark.sql(f"CREATE TABLE raw_d3.browser_events ({', '.join(cols)}, load_hour TIMESTAMP_NTZ, delivery STRING) "
              "USING parquet PARTITIONED BY (load_hour, delivery)")
    deliver(root, "browser_events", "2024-1-01-H05.jsonl", [{"event_id": "e", "click_id": "c", "event_timestamp": "2024-01-01T05:00:00Z"}])
    ingest.ingest_hours(spark, root, [HOUR], db="raw_d3", consume=True)
    r = spark.table("raw_d3.browser_events").first()
    assert (r.event_id, r.click_id, r.event_timestamp) == ("e", "c", HOUR)
    assert not os.listdir(f"{root}/data/browser_events") or os.listdir(f"{root}/data/browser_events") == [".2024-1-01-H05.jsonl.crc"]


@pytest.mark.parametrize("text,micros", [("2024-01-01 05:00:00", 0), ("2024-01-01T05:00:00Z", 0),
                                         ("2024-01-01T05:00:00.5", 500000), ("2024-01-01 05:00:00.123456", 123456)])
def test_timestamps(spark, root, text, micros):
    deliver(root, "browser_events", "2024-1-01-H05.jsonl", [{"event_id": "e", "event_timestamp": text}])
    df = ingest.read_json_feed(spark, f"{root}/data/browser_events/*.jsonl", "browser_events")
    assert df.first().event_timestamp == HOUR.replace(microsecond=micros)


def test_year_of_hours_is_listed_once(spark, root, monkeypatch):
    deliver(root, "geo_events", "2024-1-01-H05.jsonl", [geo(1)])
    calls, real = [], ingest.listing
    monkeypatch.setattr(ingest, "listing", lambda s, p: calls.append(p) or real(s, p))
    hours = ingest.hours_between(dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31))
    present, missing = ingest.existing(spark, [ingest.landing_path(root, "geo_events", h) for h in hours])
    assert len(calls) == 1 and len(present) == 1 and len(missing) == len(hours) - 1


def test_source_pivot_has_every_source(spark):
    mart = spark.createDataFrame([(HOUR, "newsletter", 47), (HOUR, "google", 3)], "date_part timestamp_ntz, utm_source string, sm long")
    assert report.source_pivot(mart, None, "2024-01-01", "2024-01-02").collect()[0].asDict() == {"date_part": HOUR, "google": 3, "newsletter": 47}
