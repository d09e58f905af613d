"""The hourly run over touched sessions equals a rebuild, whatever is delivered, replaced or interrupted."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import tempfile

import pytest

from clickmart.plans import incremental, pipeline
from clickmart.plans.lake import Lake
from clickmart.sources import ingest, ledger, schemas
from tests.conftest import rows

HOURS = [dt.datetime(2024, 1, 1, h) for h in range(4)]


def deliver(root, rng, hour, n):
    """Random files of one hour: few sessions and event ids, so that ids are shared, repeated and late; some keys are null."""
    sessions, ids = [f"s{i}" for i in range(9)] + [None], [f"e{i:03d}" for i in range(120)]
    paths = ["/product_1", "/product_2", "/confirmation", "/cart", "/elsewhere"]
    at = lambda: f"2024-01-01 {rng.randint(0, 3):02d}:{rng.randint(0, 3):02d}:0{rng.randint(0, 2)}"
    make = {
        "browser_events": lambda: {"event_id": rng.choice(ids), "click_id": rng.choice(sessions), "event_timestamp": rng.choice([at(), at(), at(), None]),
                                   "browser_name": rng.choice("CF")},
        "location_events": lambda: {"event_id": rng.choice(ids), "page_url": "u", "page_url_path": rng.choice(paths),
                                    "utm_source": rng.choice(["a", "b", None]), "utm_campaign": rng.choice("xy"), "utm_medium": "m"},
        "device_events": lambda: {"click_id": rng.choice(sessions), "os_name": rng.choice("IA"), "device_type": "Mobile", "user_custom_id": rng.choice(["u1", "u2", None])},
        "geo_events": lambda: {"click_id": rng.choice(sessions), "geo_country": rng.choice(["DE", "US"])},
    }
    for feed in schemas.FEEDS:
        path = ingest.landing_path(root, feed, hour)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("".join(json.dumps(make[feed]()) + "\n" for _ in range(n if feed in ("browser_events", "location_events") else n // 6)))


def fresh(spark, name):
    lake = incremental.Lakehouse(*(f"{name}_{layer}" for layer in ("raw", "stage", "mart", "state")))
    for db in (lake.raw, lake.stage, lake.mart, lake.state):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return lake


def check(spark, lake):
    """Stage and marts as they would be built from the raw tables."""
    whole = Lake(ingest.read_raw(spark, lake.raw))
    for name in pipeline.STAGE_TABLES:
        got = incremental._read(spark, f"{lake.stage}.{name}").drop("home")
        assert rows(got) == rows(whole.stage[name].select(*got.columns)), name
    for name, got in pipeline.load_marts(spark, lake.mart, cache=False).items():
        assert rows(got) == rows(whole.marts[name].select(*got.columns)), name


def test_deliveries_in_any_order(spark, monkeypatch):
    rng, root, lake = random.Random(5), tempfile.mkdtemp(prefix="incremental-"), fresh(spark, "inc1")
    deliver(root, rng, HOURS[0], 40)
    deliver(root, rng, HOURS[2], 40)
    incremental.backfill(spark, root, HOURS[0], HOURS[-1], lake=lake)
    check(spark, lake)
    assert incremental.propagate(spark, lake) is None

    deliver(root, rng, HOURS[1], 12)  # late
    deliver(root, rng, HOURS[0], 25)  # again, with other rows
    real, calls = incremental._swap, []

    def broken(spark, lake, path):
        calls.append(path)
        if len(calls) == 1:
            monkeypatch.setattr(incremental, "STAGE_TABLES", pipeline.STAGE_TABLES[:3])
            real(spark, lake, path)
            monkeypatch.setattr(incremental, "STAGE_TABLES", pipeline.STAGE_TABLES)
            raise RuntimeError("lost in the middle of a swap")
        real(spark, lake, path)

    monkeypatch.setattr(incremental, "_swap", broken)
    with pytest.raises(RuntimeError, match="lost"):
        incremental.backfill(spark, root, HOURS[0], HOURS[-1], lake=lake)
    assert incremental.propagate(spark, lake) is not None
    assert calls[0] == calls[1]  # the same stored rows
    check(spark, lake)


def test_emptied_delivery(spark):
    rng, root, lake = random.Random(7), tempfile.mkdtemp(prefix="incremental-"), fresh(spark, "inc2")
    deliver(root, rng, HOURS[0], 10)
    incremental.run_hour(spark, root, HOURS[0], lake=lake)
    deliver(root, rng, HOURS[0], 0)
    incremental.run_hour(spark, root, HOURS[0], lake=lake)
    check(spark, lake)
    assert incremental._read(spark, f"{lake.stage}.events").count() == 0
    assert ledger.current(spark, lake.raw).where("loads = 2").count() == 4


def test_only_touched_hours_are_read(spark):
    """Sessions of one hour each: a delivery's raw rows come from its own hour."""
    root, lake = tempfile.mkdtemp(prefix="incremental-"), fresh(spark, "inc3")
    for h, hour in enumerate(HOURS):
        for feed in schemas.FEEDS:
            path = ingest.landing_path(root, feed, hour)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w") as f:
                f.write(json.dumps({"event_id": f"e{h}", "click_id": f"s{h}", "event_timestamp": f"{hour}", "page_url_path": "/confirmation"}) + "\n")
    incremental.backfill(spark, root, HOURS[0], HOURS[2], lake=lake)
    seen = []
    real = incremental._raw_rows
    incremental._raw_rows = lambda spark, lake, sessions: seen.append((sessions.collect(), real(spark, lake, sessions))) or seen[-1][1]
    try:
        incremental.run_hour(spark, root, HOURS[3], lake=lake)
    finally:
        incremental._raw_rows = real
    sessions, feeds = seen[0]
    assert [tuple(r) for r in sessions] == [("s3",)]
    assert {feed: df.count() for feed, df in feeds.items()} == dict.fromkeys(schemas.FEEDS, 1)
    check(spark, lake)


def test_session_that_overwrites_whole_tables(spark):
    """Spark's own setting of partitionOverwriteMode, under which an overwrite replaces all of a table that does not say otherwise."""
    rng, root, lake = random.Random(9), tempfile.mkdtemp(prefix="incremental-"), fresh(spark, "inc4")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        for hour in HOURS[:2]:
            deliver(root, rng, hour, 12)
            incremental.run_hour(spark, root, hour, lake=lake)
            check(spark, lake)
    finally:
        spark.conf.set(mode, before)
    assert {r[0] for r in spark.table(f"{lake.raw}.browser_events").select("load_hour").distinct().collect()} == set(HOURS[:2])


def test_many_keys_are_shuffled(spark, monkeypatch):
    """More keys than are sent, in files that Spark would send whole: no join sends them, and the run equals a rebuild."""
    keys = incremental.cut(spark.range(200).selectExpr("concat('s', id) AS session_id"), "many-keys")
    wide = spark.range(500).selectExpr("concat('s', id % 300) AS click_id", "id")
    for sent, join in ((200, "BroadcastHashJoin"), (199, "SortMergeJoin")):
        monkeypatch.setattr(incremental, "SENT_KEYS", sent)
        for how in ("left_semi", "left_anti", "inner"):
            df = incremental._of(wide, incremental._sent(keys), "click_id", how)
            assert df.columns == ["click_id", "id"] and df.count() == {"left_semi": 400, "left_anti": 100, "inner": 400}[how]
            assert join in df._jdf.queryExecution().sparkPlan().toString(), how

    monkeypatch.setattr(incremental, "SENT_KEYS", 0)
    rng, root, lake = random.Random(11), tempfile.mkdtemp(prefix="incremental-"), fresh(spark, "inc5")
    deliver(root, rng, HOURS[0], 30)
    deliver(root, rng, HOURS[1], 30)
    incremental.backfill(spark, root, HOURS[0], HOURS[-1], lake=lake)
    deliver(root, rng, HOURS[0], 30)
    incremental.backfill(spark, root, HOURS[0], HOURS[-1], lake=lake)
    check(spark, lake)
    for name in pipeline.STAGE_TABLES:  # rows of a home come from many tasks, and go to one file while they are few
        df = incremental._read(spark, f"{lake.stage}.{name}")
        assert len(df.inputFiles()) == df.select("home").distinct().count(), name


def test_few_tables_at_a_time(spark):
    """Queries in flight hold driver memory: there are no more than AT_ONCE, whatever the number of tables."""
    import threading
    import time

    lock, now, most = threading.Lock(), [0], [0]

    def work(name):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return name

    assert incremental._side_by_side(work, pipeline.MART_TABLES) == list(pipeline.MART_TABLES)
    assert most[0] <= incremental.AT_ONCE


def test_purchases_of_a_run_send_nothing(spark, monkeypatch):
    """Confirmations and their counts are small files of many rows: a run's purchases join them by shuffles, with the same rows."""
    from clickmart.operators import stage

    tr = incremental.cut(spark.range(300).selectExpr(
        "concat('e', id) AS event_id", "concat('s', id % 7) AS session_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS event_timestamp",
        "IF(id % 5 = 0, '/confirmation', '/product_1') AS page_url_path"), "few-transitions")
    plans, real = [], stage.cut
    monkeypatch.setattr(stage, "cut", lambda df, name: plans.append(df) or real(df, name))
    got = incremental._stage_rows("purchases", {}, tr)
    assert len(plans) == 4
    for df in (*plans, got):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().sparkPlan().toString()
    assert rows(got) == rows(stage.purchases_from_events(tr))
