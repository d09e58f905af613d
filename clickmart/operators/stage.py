"""Stage layer: raw feeds -> session-level facts.

Feeds: ``browser`` (event_id, click_id, ...), ``location`` (event_id, page and
marketing columns), ``device`` and ``geo`` (click_id, ...). ``click_id`` is the
session. Nothing dedups raw events: duplicates fan out through the joins
exactly as in bag-semantics SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import epoch_micros, is_confirmation, is_product
from clickmart.operators.prefix import DEFAULT_BUCKETS, strictly_earlier
from clickmart.session import cut

MARKETING = ("referer_url", "referer_medium", "utm_medium", "utm_source",
             "utm_content", "utm_campaign")


def conversion(browser: DataFrame, location: DataFrame) -> DataFrame:
    """Each session's marketing columns, taken from its greatest event_id
    among events present in both feeds (greatest UUID, not latest event).

    ``max`` is a partial (map-side) aggregate, so a huge session costs one row
    per task; duplicate location rows of the chosen id fan out.
    """
    ids = location.select("event_id")
    present = (browser.select(F.col("click_id").alias("session_id"), "event_id")
               .join(ids, "event_id", "left_semi"))
    return conversion_from_ids(present, location)


def conversion_from_ids(session_events: DataFrame, location: DataFrame) -> DataFrame:
    """S1 from (session_id, event_id) pairs already known to be in both feeds
    (e.g. a materialised transitions table); multiplicity does not matter."""
    last = session_events.groupBy("session_id").agg(F.max("event_id").alias("event_id"))
    return (last.join(location.select("event_id", *MARKETING), "event_id")
            .select("session_id", *MARKETING))


def devices(device: DataFrame) -> DataFrame:
    """Distinct device attributes per session."""
    return device.select(F.col("click_id").alias("session_id"), "os_name", "os_timezone",
                         "device_type", "user_custom_id", "user_domain_id").distinct()


def events(browser: DataFrame) -> DataFrame:
    """S3: distinct (session, event, time, browser)."""
    return browser.select(F.col("click_id").alias("session_id"), "event_id",
                          "event_timestamp", "browser_name").distinct()


def events_basic(browser: DataFrame) -> DataFrame:
    """Notebook variant without the browser column."""
    return browser.select(F.col("click_id").alias("session_id"), "event_id",
                          "event_timestamp").distinct()


def geo(geo_feed: DataFrame) -> DataFrame:
    """Distinct geo attributes per session."""
    return geo_feed.select(F.col("click_id").alias("session_id"), "geo_latitude", "geo_longitude",
                           "geo_country", "geo_timezone", "geo_region_name",
                           "ip_address").distinct()


def session_info(browser: DataFrame) -> DataFrame:
    """Distinct browser attributes per session."""
    return browser.select(F.col("click_id").alias("session_id"), "browser_name",
                          "browser_user_agent", "browser_language").distinct()


def transitions(browser: DataFrame, location: DataFrame) -> DataFrame:
    """Every (location row, browser row) pair with the same event_id."""
    b = browser.select("event_id", F.col("click_id").alias("session_id"), "browser_name",
                       "event_timestamp")
    l = location.select("event_id", "page_url", "page_url_path")
    return (l.join(b, "event_id")
            .select("event_id", "session_id", "page_url", "browser_name", "page_url_path",
                    "event_timestamp"))


def transitions_basic(browser: DataFrame, location: DataFrame) -> DataFrame:
    """Notebook variant."""
    b = browser.select("event_id", "event_timestamp")
    l = location.select("event_id", "page_url", "page_url_path")
    return l.join(b, "event_id").select("event_id", "page_url", "page_url_path", "event_timestamp")


def purchases(browser: DataFrame, location: DataFrame,
              bucket_us: int | Sequence[int] = DEFAULT_BUCKETS) -> DataFrame:
    """Products bought at each confirmation.

    Visiting a ``/product_*`` page puts one item in the cart, a
    ``/confirmation`` pays for the cart. Per confirmation row:

    1. ``n`` = product rows of the same session strictly earlier, at least 1
       (an empty cart counts 1, and that 1 is subtracted again later);
    2. ``cum`` = sum of ``n`` over confirmation rows sharing (event_id, time),
       attached to every confirmation row with that event_id (duplicate ids fan
       out and can make results negative, as in the SQL definition);
    3. result = ``cum`` minus the greatest ``cum`` of strictly earlier
       confirmations of the session (0 if none).

    Both "strictly earlier" steps are range frames (micros, -1), never a
    self-join; rows with a NULL session or time see nothing earlier (prior = 0).
    """
    b = browser.select(F.col("click_id").alias("session_id"), "event_id", "event_timestamp")
    l = (location.select("event_id", "page_url_path")
         .where(is_product("page_url_path") | is_confirmation("page_url_path")))
    return purchases_from_events(b.join(l, "event_id"), bucket_us)


def purchases_from_events(joined: DataFrame, bucket_us: int | Sequence[int] = DEFAULT_BUCKETS, shuffled: bool = False) -> DataFrame:
    """S5 from browser-location joined rows (session_id, event_id,
    event_timestamp, page_url_path), e.g. a materialised transitions table.

    Tied rows (same session and micros) share every "strictly earlier" frame,
    so each step first collapses the rows to distinct (session, micros) keys
    with a map-side-combined aggregate, runs the running aggregate over those
    keys only (``strictly_earlier``: split by nested time buckets, so one session
    never fills a task) and joins the result back. A row with a NULL session or
    time gets a key of its own, made of its event_id, and time 0: nothing is
    earlier there, and no NULL group forms. The plan is cut at the base rows,
    at their keys and at the cumulated counts: each is evaluated once.
    ``shuffled``: no join sends a side from the driver, however small its files are.
    """
    side = lambda df: df.hint("merge") if shuffled else df
    l_ok = is_product("page_url_path") | is_confirmation("page_url_path")
    us = epoch_micros("event_timestamp")
    valid = F.col("session_id").isNotNull() & us.isNotNull()
    ev = cut(joined.where(l_ok).select(
        "session_id", "event_id", "event_timestamp",
        F.when(valid, F.concat(F.lit("s"), "session_id")).otherwise(F.concat(F.lit("e"), "event_id")).alias("who"),
        F.when(valid, us).otherwise(F.lit(0).cast("long")).alias("us"),
        is_product("page_url_path").cast("long").alias("is_product"),
        is_confirmation("page_url_path").alias("is_conf")), "purchase-events")
    key = ["who", "us"]

    # 1. products strictly before each (session, time) that has a confirmation
    at_key = cut(ev.groupBy(*key).agg(F.sum("is_product").alias("p"),
                                      F.max(F.col("is_conf").cast("int")).alias("c")), "purchase-keys")
    before = (strictly_earlier(at_key, "who", "us", "p", "sum", "n_prior", bucket_us, shuffled)
              .where("c = 1")
              .select(*key, F.greatest(F.lit(1).cast("long"), F.col("n_prior")).alias("n")))
    conf = ev.where("is_conf").select("session_id", "event_id", "event_timestamp", *key).join(side(before), key)

    # 2. per (event_id, time): sum of n, attached to every confirmation with that id
    conf = cut(conf, "purchase-confirmations")
    pc = (conf.groupBy("event_id", F.col("event_timestamp").alias("pc_ts"))
          .agg(F.sum("n").alias("product_count")).drop("pc_ts"))
    cum = cut(conf.drop("n").join(side(pc), "event_id"), "purchase-counts")

    # 3. minus the greatest cumulative count of strictly earlier confirmations
    top = cum.groupBy(*key).agg(F.max("product_count").alias("m"))
    prior = (strictly_earlier(top, "who", "us", "m", "max", "prior_max", bucket_us, shuffled)
             .select(*key, "prior_max"))
    return cum.join(side(prior), key).select(
        "session_id", "event_timestamp",
        (F.col("product_count") - F.coalesce("prior_max", F.lit(0))).alias("product_count"))
