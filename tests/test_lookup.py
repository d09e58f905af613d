"""Lookups that skip row groups and shuffle no feed, multiplied rows, the funnel, and user sets."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from clickmart.operators import explore, marts
from clickmart.plans.lake import Lake
from clickmart.sources import ingest
from tests.conftest import at, frame, rows

SF = "/root/testdata/sf0.01"


def final_plan(df) -> str:
    """The plan that ran (adaptive plans are final after an action)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df) -> dict[str, int]:
    """Rows that each scan of the executed plan read, by table."""
    def walk(node, found):
        name = node.nodeName()
        if name.startswith("Scan") and node.metrics().contains("numOutputRows"):
            found[re.sub(r".*\.", "", name.split(" ")[-1])] = node.metrics().apply("numOutputRows").value()
        if "AdaptiveSparkPlan" in name:
            walk(node.executedPlan(), found)
        if "QueryStage" in name:
            walk(node.plan(), found)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), found)
        return found
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan(), {})


@pytest.fixture(scope="module")
def lookup(spark):
    ingest.create_layers(spark, ["lookup"])
    k = Lake.from_dir(spark, SF)
    spark.conf.set("parquet.block.size", 64 << 10)
    try:
        out = {feed: explore.write_lookup(k.feeds[feed], f"lookup.{feed}", column, rows_per_file=500)
               for feed, column in (("browser_events", "click_id"), ("location_events", "event_id"), ("device_events", "click_id"), ("geo_events", "click_id"))}
    finally:
        spark.conf.unset("parquet.block.size")
    return k, out


def test_journey_reads_a_part_and_shuffles_no_feed(lookup):
    k, t = lookup
    session = k.browser.groupBy("click_id").count().orderBy(F.desc("count"), "click_id").first()["click_id"]
    got = explore.session_journey(t["browser_events"], t["location_events"], session)
    assert rows(got) == rows(explore.session_journey(k.browser, k.location, session)) and got.count() > 3
    assert "hashpartitioning(event_id" not in final_plan(got)
    assert scanned_rows(got)["location_events"] <= 500 * got.count() < 10_000


def test_ip_detail_shuffles_no_feed(lookup, monkeypatch):
    k, t = lookup
    want = rows(explore.ip_detail(k.geo, k.device, k.browser, "10.0.0.7"))
    for pushed, sent in ((explore.PUSHED_KEYS, explore.SENT_KEYS), (10 ** 6, 10 ** 6), (0, 0)):
        monkeypatch.setattr(explore, "PUSHED_KEYS", pushed)
        monkeypatch.setattr(explore, "SENT_KEYS", sent)
        got = explore.ip_detail(t["geo_events"], t["device_events"], t["browser_events"], "10.0.0.7")
        assert rows(got) == want and len(want) > 10
    assert rows(explore.ip_detail(k.geo, k.device, k.browser, "none")) == []


def test_wide_events_multiplies_counts(spark):
    b = frame(spark, "browser_events", [{"event_id": f"e{i}", "click_id": c} for i, c in enumerate(["s1", "s1", "s2", None])])
    loc = frame(spark, "location_events", [{"event_id": "e0", "page_url_path": "/a"}, {"event_id": "e0", "page_url_path": "/b"}])
    d = frame(spark, "device_events", [{"click_id": "s1", "os_name": "x"}] * 1500 + [{"click_id": "s1", "os_name": "y"}] + [{"click_id": None, "os_name": "z"}])
    g = frame(spark, "geo_events", [{"click_id": "s1", "geo_country": "DE"}] * 2)
    got = explore.wide_events(b, d, g, loc)
    counts = {(r["event_id"], r["page_url_path"], r["os_name"]): r["n"] for r in got.groupBy("event_id", "page_url_path", "os_name").agg(F.count("*").alias("n")).collect()}
    assert counts == {("e0", "/a", "x"): 3000, ("e0", "/b", "x"): 3000, ("e0", "/a", "y"): 2, ("e0", "/b", "y"): 2,
                      ("e1", None, "x"): 3000, ("e1", None, "y"): 2, ("e2", None, None): 1, ("e3", None, None): 1}


@pytest.mark.parametrize("bucket", ["minute", "hour"])
def test_funnel_equals_brute_force(spark, bucket):
    rng = random.Random(4)
    paths = ["/product_1", "/cart", "/payment", "/confirmation", "/home"]
    clicks = [(f"s{rng.randint(0, 40)}", rng.choice(paths), at(rng.choice([0, 0.25, 0.5, 1, 59, 60, 61, 130]))) for _ in range(400)]
    clicks += [(None, p, at(i)) for i, p in enumerate(paths)] + [("s1", "/cart", None)]
    transitions = spark.createDataFrame(clicks, "session_id string, page_url_path string, event_timestamp timestamp_ntz")
    devices = spark.createDataFrame([(f"s{i}", f"d{i % 3}") for i in range(0, 50)] * 2 + [("s1", "d9")], "session_id string, device_type string")
    want: dict = {}
    for s in {c[0] for c in clicks if c[0]}:
        t = dt.datetime.min
        for k, name in enumerate(explore.FUNNEL):
            later = [c[2] for c in clicks if c[0] == s and c[2] and c[2] > t and (c[1] == paths[k])]
            if not later:
                break
            t = min(later)
            for kind in {f"d{int(s[1:]) % 3}"} | ({"d9"} if s == "s1" else set()):
                want[kind, k, name] = want.get((kind, k, name), 0) + 1
    got = explore.session_funnel(transitions, devices, bucket)
    assert {(r["device_type"], r["step"], r["name"]): r["sessions"] for r in got.collect()} == want


def test_user_sets(spark):
    k = Lake.from_dir(spark, SF)
    s = {name: k.stage[name].cache() for name in ("devices", "conversion", "events")}
    numbers = marts.user_numbers(s["devices"]).cache()
    n = numbers.count()
    assert numbers.agg(F.countDistinct("user"), F.max("user"), F.min("user")).first() == (n, n - 1, 0)
    whole = marts.users_segments(s["devices"], s["conversion"])
    sets = marts.user_sets(s["devices"], s["conversion"], s["events"], numbers)
    assert rows(marts.users_segments_merged(sets)) == rows(whole.select(*marts.users_segments_merged(sets).columns))
    estimated = {tuple(r)[:3]: r["users"] for r in marts.users_segments_estimated(marts.user_sketches(s["devices"], s["conversion"], s["events"])).collect()}
    exact = {tuple(r)[:3]: r["users"] for r in whole.collect()}
    error = max(abs(estimated[x] - exact[x]) / exact[x] for x in exact)
    assert estimated.keys() == exact.keys() and error < 0.05


def test_user_sets_without_users_or_clicks(spark):
    d = spark.createDataFrame([("s1", "i", "m", None), ("s2", "i", "m", "u"), ("s3", "a", "m", "u")], "session_id string, os_name string, device_type string, user_custom_id string")
    c = spark.createDataFrame([("s1", "x"), ("s2", "y"), ("s3", "y")], "session_id string, utm_source string")
    e = spark.createDataFrame([("s1", at(0)), ("s2", at(0))], "session_id string, event_timestamp timestamp_ntz")
    sets = marts.user_sets(d, c, e, marts.user_numbers(d))
    assert rows(marts.users_segments_merged(sets)) == rows(marts.users_segments(d, c)) == [("a", "m", "y", 1), ("i", "m", "x", 0), ("i", "m", "y", 1)]
    assert rows(marts.users_segments_merged(sets, "2024-01-01 10:00:00", "2024-01-01 10:00:00")) == [("i", "m", "x", 0), ("i", "m", "y", 1)]
