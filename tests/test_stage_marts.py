"""Stage and mart semantics on hand-made frames (traps of the definitions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickmart.functions import event_label, is_product, product_name
from clickmart.operators import marts, stage
from tests.conftest import at, frame, rows


def test_path_matching_and_product_names(spark):
    paths = ["/product_1", "/products", "/product-x", "/product", "/product_a_b", "/home"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r.p: (r.m, r.name, r.label) for r in df.select(
        "p", is_product("p").alias("m"), product_name("p").alias("name"),
        event_label("p").alias("label")).collect()}
    assert got["/product_1"] == (True, "1", "add product")
    assert got["/products"] == (True, "/products", "add product")
    assert got["/product-x"] == (True, "/product-x", "add product")
    assert got["/product"][0] is False and got["/product"][2] is None
    assert got["/product_a_b"][1] == "a_b"
    assert got["/home"][2] == "go home"


def test_conversion_takes_greatest_id_and_fans_out(spark):
    # the earlier event has the greater id -> its marketing columns win
    b = frame(spark, "browser_events", [
        {"event_id": "ffff", "click_id": "s", "event_timestamp": at(0)},
        {"event_id": "0000", "click_id": "s", "event_timestamp": at(5)},
        {"event_id": "zzzz", "click_id": "s", "event_timestamp": at(9)}])   # no location row
    l = frame(spark, "location_events", [
        {"event_id": "ffff", "utm_source": "early"},
        {"event_id": "ffff", "utm_source": "early-dup"},
        {"event_id": "0000", "utm_source": "late"}])
    assert rows(stage.conversion(b, l), "session_id", "utm_source") == [("s", "early"), ("s", "early-dup")]


def test_transitions_bag_semantics(spark):
    b = frame(spark, "browser_events", [{"event_id": "e", "click_id": "s", "event_timestamp": at(0)}] * 2)
    l = frame(spark, "location_events", [{"event_id": "e", "page_url_path": "/home"}] * 3)
    assert stage.transitions(b, l).count() == 6


def test_distinct_projections(spark):
    d = frame(spark, "device_events", [
        {"click_id": "s", "os": "a", "os_name": "iOS", "device_type": "Mobile"},
        {"click_id": "s", "os": "b", "os_name": "iOS", "device_type": "Mobile"}])
    assert stage.devices(d).count() == 1


def test_events_distribution_counts_each_device_row(spark):
    tr = spark.createDataFrame(
        [("e1", "s", "/home", "Chrome", at(0)), ("e2", "s", "/error", "Chrome", at(1))],
        "event_id string, session_id string, page_url_path string, browser_name string, "
        "event_timestamp timestamp_ntz")
    dv = spark.createDataFrame([("s", "iOS", "Mobile"), ("s", "iOS", "Tablet")],
                               "session_id string, os_name string, device_type string")
    out = rows(marts.events_distribution_hourly(tr, dv), "event", "device_type", "cnt")
    assert out == [("go home", "Mobile", 1), ("go home", "Tablet", 1),
                   (None, "Mobile", 1), (None, "Tablet", 1)]


def _stage_fixture(spark):
    p = spark.createDataFrame(
        [("s1", at(0), 2), ("s1", at(70), 1), ("s2", at(5), 3), ("s3", at(5), 4)],
        "session_id string, event_timestamp timestamp_ntz, product_count long")
    d = spark.createDataFrame(
        [("s1", "iOS", "Mobile", "u1"), ("s1", "iOS", "Mobile", "u9"), ("s2", "Linux", "Computer", "u2")],
        "session_id string, os_name string, device_type string, user_custom_id string")
    c = spark.createDataFrame(
        [("s1", "google", "campaign_0", "cpc"), ("s2", None, "campaign_1", "email"),
         ("s2", "bing", "campaign_1", "email")],
        "session_id string, utm_source string, utm_campaign string, utm_medium string")
    return p, d, c


def test_segments_one_level_equals_two_levels(spark):
    p, d, c = _stage_fixture(spark)
    one = marts.users_purchases_segments(p, d, c)
    two = (p.join(d, "session_id").join(c, "session_id")
           .groupBy(F.date_trunc("hour", "event_timestamp").alias("hr"), "user_custom_id",
                    "device_type", "os_name", "utm_source")
           .agg(F.sum("product_count").alias("products"))
           .groupBy("device_type", "utm_source", "os_name").agg(F.sum("products").alias("products")))
    assert rows(one) == rows(two.select(*one.columns))


def test_hourly_marts_preaggregation_matches_join_first(spark):
    p, d, c = _stage_fixture(spark)
    got = rows(marts.campaign_purchases_hourly(p, c), "utm_campaign", "utm_medium", "sm")
    assert got == [("campaign_0", "cpc", 1), ("campaign_0", "cpc", 2), ("campaign_1", "email", 6)]
    # session s3 has no conversion row: dropped (inner join)
    total = marts.source_purchases_hourly(p, c).agg(F.sum("sm")).first()[0]
    assert total == 2 + 1 + 3 + 3


def test_products_hourly_sums_equal_purchases(spark):
    p, _, _ = _stage_fixture(spark)
    assert marts.products_purchased_hourly(p).agg(F.sum("cnt")).first()[0] == 10


def test_users_segments_distinct_users(spark):
    p, d, c = _stage_fixture(spark)
    got = rows(marts.users_segments(d, c), "os_name", "utm_source", "users")
    assert got == [("Linux", "bing", 1), ("Linux", None, 1), ("iOS", "google", 2)]


def test_feed_level_marts_equal_transitions_marts_with_copies(spark):
    b = frame(spark, "browser_events", [
        {"event_id": "e1", "click_id": "s", "event_timestamp": at(0), "browser_name": "Chrome"}] * 3 + [
        {"event_id": "e2", "click_id": "s", "event_timestamp": at(70), "browser_name": "Chrome"},
        {"event_id": "e3", "click_id": "t", "event_timestamp": at(5), "browser_name": "Safari"}])
    l = frame(spark, "location_events", [{"event_id": "e1", "page_url_path": "/product_7"}] * 4 + [
        {"event_id": "e2", "page_url_path": "/home"}, {"event_id": "e3", "page_url_path": "/error"},
        {"event_id": "e9", "page_url_path": "/cart"}])
    dv = spark.createDataFrame([("s", "iOS", "Mobile"), ("s", "iOS", "Tablet"), ("t", "Linux", "Computer")],
                               "session_id string, os_name string, device_type string")
    tr = stage.transitions(b, l)
    assert rows(marts.events_distribution_hourly_from_feeds(b, l, dv)) == \
        rows(marts.events_distribution_hourly(tr, dv))
    assert rows(marts.events_distribution_basic_from_feeds(b, l)) == rows(marts.events_distribution_basic(tr))
    assert rows(marts.top_products_from_feeds(b, l)) == rows(marts.top_products(tr)) == [("7", 12)]
