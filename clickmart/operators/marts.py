"""Mart layer: stage tables -> hourly and per-segment aggregates.

``date_part`` is the hour of the event (TIMESTAMP_NTZ). Every mart that joins
stage tables on ``session_id`` first collapses the fact side to one row per
(session, grouping keys) with a map-side-combined aggregate, so a huge session
shrinks to a handful of rows before any shuffle join, and the join input is
bounded by the number of sessions, not clicks. Sums distribute over the join
fan-out, so the result equals aggregating the joined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import event_label, hour_start, is_product, product_name
from clickmart.session import cut


def _purchases_by_session_hour(purchases: DataFrame) -> DataFrame:
    return (purchases.groupBy("session_id", hour_start("event_timestamp").alias("date_part"))
            .agg(F.sum("product_count").alias("sm")))


def campaign_purchases_hourly(purchases: DataFrame, conversion: DataFrame) -> DataFrame:
    """M1: products bought per (campaign, medium, hour)."""
    c = conversion.select("session_id", "utm_campaign", "utm_medium")
    return (_purchases_by_session_hour(purchases).join(c, "session_id")
            .groupBy("utm_campaign", "utm_medium", "date_part")
            .agg(F.sum("sm").alias("sm")))


def campaign_purchases_basic(purchases: DataFrame, conversion: DataFrame) -> DataFrame:
    """Notebook variant without utm_medium."""
    c = conversion.select("session_id", "utm_campaign")
    return (_purchases_by_session_hour(purchases).join(c, "session_id")
            .groupBy("utm_campaign", "date_part").agg(F.sum("sm").alias("sm")))


def source_purchases_hourly(purchases: DataFrame, conversion: DataFrame) -> DataFrame:
    """M2: products bought per (utm_source, hour)."""
    c = conversion.select("session_id", "utm_source")
    return (_purchases_by_session_hour(purchases).join(c, "session_id")
            .groupBy("utm_source", "date_part").agg(F.sum("sm").alias("sm")))


def events_distribution_hourly(transitions: DataFrame, devices: DataFrame) -> DataFrame:
    """M3: page events per (label, hour, os, device type, browser).

    Unknown paths keep a NULL label group; sessions with several distinct
    device rows count once per device row (inner join, bag semantics).
    """
    t = (transitions.groupBy("session_id", event_label("page_url_path").alias("event"),
                             hour_start("event_timestamp").alias("date_part"), "browser_name")
         .agg(F.count(F.lit(1)).alias("cnt")))
    d = devices.select("session_id", "os_name", "device_type")
    return (t.join(d, "session_id")
            .groupBy("event", "date_part", "os_name", "device_type", "browser_name")
            .agg(F.sum("cnt").alias("cnt")))


def events_distribution_basic(transitions: DataFrame) -> DataFrame:
    """Page events per (label, hour), no device join."""
    return (transitions.groupBy(event_label("page_url_path").alias("event"),
                                hour_start("event_timestamp").alias("date_part"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def products_purchased_hourly(purchases: DataFrame) -> DataFrame:
    """M4: products bought per hour."""
    return (purchases.groupBy(hour_start("event_timestamp").alias("date_part"))
            .agg(F.sum("product_count").alias("cnt")))


def top_products(transitions: DataFrame) -> DataFrame:
    """M5: product page visits (cart additions) per product."""
    return (transitions.where(is_product("page_url_path"))
            .groupBy(product_name("page_url_path").alias("product"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def users_purchases_segments(purchases: DataFrame, devices: DataFrame,
                             conversion: DataFrame) -> DataFrame:
    """M6: products bought per (device type, utm_source, os).

    The definition sums per-(hour, user, segment) sums; a sum of sums over a
    partition of the rows is the plain sum, so one aggregate level suffices.
    """
    p = purchases.groupBy("session_id").agg(F.sum("product_count").alias("products"))
    d = devices.select("session_id", "device_type", "os_name")
    c = conversion.select("session_id", "utm_source")
    return (p.join(d, "session_id").join(c, "session_id")
            .groupBy("device_type", "utm_source", "os_name")
            .agg(F.sum("products").alias("products")))


def users_segments(devices: DataFrame, conversion: DataFrame) -> DataFrame:
    """M7: distinct users per (os, device type, utm_source).

    Both sides are reduced to distinct tuples first (a distinct count does not
    see multiplicity), then the exact two-phase distinct count runs.
    """
    d = devices.select("session_id", "os_name", "device_type", "user_custom_id").distinct()
    c = conversion.select("session_id", "utm_source").distinct()
    return (d.join(c, "session_id")
            .groupBy("os_name", "device_type", "utm_source")
            .agg(F.countDistinct("user_custom_id").alias("users")))


# ---- mergeable user sets (M7 over any range of hours) -------------------------
# A distinct count cannot be added up, sets can. Users are numbered once, and the
# sets are kept per hour and segment, as exact bitmaps or as sketches.

SEGMENT = ("os_name", "device_type", "utm_source")


def user_numbers(devices: DataFrame) -> DataFrame:
    """user_custom_id and a number of its own for every user, close to dense (stored: the numbers stay)."""
    users = devices.select("user_custom_id").where(F.col("user_custom_id").isNotNull()).distinct()
    per_part = cut(users.select("user_custom_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "users")
    sizes = per_part.groupBy("part").agg(F.count("*").alias("n"))
    begin = sizes.withColumn("begin", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return per_part.join(F.broadcast(begin.select("part", F.coalesce("begin", F.lit(0)).alias("begin"))), "part").select(
        "user_custom_id", (F.col("begin") + F.col("id").bitwiseAND((1 << 33) - 1)).alias("user"))


def _hourly_users(devices: DataFrame, conversion: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct hour, segment and user of the sessions' clicks; sessions without a click have a null hour."""
    hours = events.select("session_id", hour_start("event_timestamp").alias("date_part")).distinct()
    d = devices.select("session_id", "os_name", "device_type", "user_custom_id").distinct()
    c = conversion.select("session_id", "utm_source").distinct()
    return d.join(c, "session_id").join(hours, "session_id", "left").select("date_part", *SEGMENT, "user_custom_id").distinct()


def user_sets(devices: DataFrame, conversion: DataFrame, events: DataFrame, numbers: DataFrame) -> DataFrame:
    """Exact bitmaps of users per hour and segment: date_part, segment, bucket (of 32,768 users), bits.

    A segment whose users are all null has a row without bucket."""
    rows = _hourly_users(devices, conversion, events).join(numbers, "user_custom_id", "left")
    return rows.groupBy("date_part", *SEGMENT, F.bitmap_bucket_number("user").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user")).alias("bits"))


def users_segments_merged(sets: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct users per segment over a range of hours (inclusive; none: all), from the union of the hours' bitmaps."""
    if start is not None:
        sets = sets.where(F.col("date_part") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        sets = sets.where(F.col("date_part") <= F.lit(end).cast("timestamp_ntz"))
    united = sets.groupBy(*SEGMENT, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*SEGMENT).agg(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)).alias("users"))


def user_sketches(devices: DataFrame, conversion: DataFrame, events: DataFrame, lg_config_k: int = 12) -> DataFrame:
    """Opt-in: HyperLogLog sketches of users per hour and segment (error about 1.04 / sqrt(2 ** lg_config_k))."""
    rows = _hourly_users(devices, conversion, events)
    return rows.groupBy("date_part", *SEGMENT).agg(F.hll_sketch_agg("user_custom_id", F.lit(lg_config_k)).alias("sketch"))


def users_segments_estimated(sketches: DataFrame) -> DataFrame:
    """Estimated distinct users per segment from the union of the hours' sketches."""
    return sketches.groupBy(*SEGMENT).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


# ---- the same marts straight from the feeds ---------------------------------
# transitions is the browser x location join on event_id; a count over it is,
# per event_id, (browser rows) x (location rows). Counting each side per
# event_id first gives the same numbers without materialising the product, so
# copies of one event -- however many -- cost linear work.

# Ids are almost unique, so a partial aggregate removes nothing: the feeds are
# dealt out by event_id once, and the counts and the join share that shuffle.

def _location_counts(location: DataFrame, *cols) -> DataFrame:
    return location.repartition("event_id").groupBy("event_id", *cols).agg(F.count(F.lit(1)).alias("l_n"))


def _browser_counts(browser: DataFrame, *cols) -> DataFrame:
    return browser.repartition("event_id").groupBy("event_id", *cols).agg(F.count(F.lit(1)).alias("b_n"))


def events_distribution_hourly_from_feeds(browser: DataFrame, location: DataFrame,
                                          devices: DataFrame) -> DataFrame:
    """M3 computed from the feeds (equal to ``events_distribution_hourly`` over
    the transitions table)."""
    l = _location_counts(location, event_label("page_url_path").alias("event"))
    b = _browser_counts(browser, F.col("click_id").alias("session_id"),
                        hour_start("event_timestamp").alias("date_part"), "browser_name")
    t = (l.join(b, "event_id")
         .groupBy("session_id", "event", "date_part", "browser_name")
         .agg(F.sum(F.col("l_n") * F.col("b_n")).alias("cnt")))
    d = devices.select("session_id", "os_name", "device_type")
    return (t.join(d, "session_id")
            .groupBy("event", "date_part", "os_name", "device_type", "browser_name")
            .agg(F.sum("cnt").alias("cnt")))


def events_distribution_basic_from_feeds(browser: DataFrame, location: DataFrame) -> DataFrame:
    """M3b computed from the feeds."""
    l = _location_counts(location, event_label("page_url_path").alias("event"))
    b = _browser_counts(browser, hour_start("event_timestamp").alias("date_part"))
    return (l.join(b, "event_id").groupBy("event", "date_part")
            .agg(F.sum(F.col("l_n") * F.col("b_n")).alias("cnt")))


def top_products_from_feeds(browser: DataFrame, location: DataFrame) -> DataFrame:
    """M5 computed from the feeds."""
    l = _location_counts(location.where(is_product("page_url_path")),
                         product_name("page_url_path").alias("product"))
    b = _browser_counts(browser)
    return (l.join(b, "event_id").groupBy("product")
            .agg(F.sum(F.col("l_n") * F.col("b_n")).alias("cnt")))
