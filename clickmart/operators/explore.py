"""Exploration queries over the raw feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions import epoch_micros, is_confirmation, is_product
from clickmart.session import cut

PUSHED_KEYS = 64  # up to so many keys become comparisons that the scan can check against row groups
SENT_KEYS = 100_000  # up to so many keys (of some 40 bytes) are sent to the tasks, more are joined by a shuffle
COPIES = 1024  # rows multiplied at a time


def only(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column is among the stored keys (distinct, one column), by how many there are.

    A few keys are compared in the scan itself, where the footer's ranges and
    bloom filters of a stored table skip row groups; some are sent to the
    tasks, which filter the rows they read; many are joined. ``df`` is shuffled in the last case only.
    """
    n = keys.limit(SENT_KEYS + 1).count()
    if n <= PUSHED_KEYS:
        found = [r[0] for r in keys.collect() if r[0] is not None]
        return df.where(reduce(Column.__or__, [F.col(column) == k for k in found], F.lit(False)))
    mine = keys.select(F.col(keys.columns[0]).alias("_key"))
    return df.join(F.broadcast(mine) if n <= SENT_KEYS else mine, F.col(column) == F.col("_key"), "left_semi")


def write_lookup(df: DataFrame, table: str, column: str, rows_per_file: int = 0) -> DataFrame:
    """Store a feed for lookups by ``column``: sorted by it in ranges, with a bloom filter of it in every row group."""
    writer = (df.repartitionByRange(F.col(column)).sortWithinPartitions(column).write.format("parquet").mode("overwrite")
              .option(f"parquet.bloom.filter.enabled#{column}", "true"))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def wide_events(browser: DataFrame, device: DataFrame, geo: DataFrame,
                location: DataFrame) -> DataFrame:
    """Every browser event with its device, geo and location rows (left joins).

    Device and geo rows of a session are reduced to their distinct values with
    a count, so a session's rows meet a few rows each, however many it has; the
    counts are multiplied out at the very end. Only browser events are dealt
    out by click_id, once: partial sums of the other two feeds join them. The output itself
    fans out by device x geo rows per session, which is the defined result.
    """
    b = browser.select("event_id", "click_id", "event_timestamp", "event_type", "browser_name")
    l = location.select("event_id", "page_url_path", "referer_medium", "utm_source",
                        "utm_campaign", "utm_medium")
    d = device.groupBy("click_id", "os_name", "device_type", "user_custom_id").agg(F.count("*").alias("_d"))
    g = geo.groupBy("click_id", "geo_country", "geo_region_name").agg(F.count("*").alias("_g"))
    wide = b.join(l, "event_id", "left").join(d, "click_id", "left").join(g, "click_id", "left")
    return _multiplied(wide.withColumn("_n", F.coalesce("_d", F.lit(1)) * F.coalesce("_g", F.lit(1)))).select(
        "event_id", "click_id", "event_timestamp", "event_type", "browser_name",
        "os_name", "device_type", "user_custom_id", "geo_country", "geo_region_name",
        "page_url_path", "referer_medium", "utm_source", "utm_campaign", "utm_medium")


def _multiplied(df: DataFrame) -> DataFrame:
    """Every row ``_n`` times, by arrays of at most COPIES (or _n / COPIES) entries."""
    parts = df.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}"))))
    size = F.least(F.lit(COPIES).cast("long"), F.col("_n") - F.col("_part") * COPIES)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("_n", "_part", "_copy")


def source_counts(feeds: dict[str, DataFrame]) -> DataFrame:
    """Row count per feed, as (source, cnt) rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("source"), "cnt")
             for name, df in feeds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def session_journey(browser: DataFrame, location: DataFrame, session_id: str) -> DataFrame:
    """One session's clicks with page and marketing columns, in time order.

    The session's clicks are read first; their event ids then select the
    location rows in the scan (``only``), so the location feed is not shuffled
    unless the session is huge.
    """
    b = cut(browser.where(F.col("click_id") == session_id)
            .select("click_id", "event_id", "event_timestamp", "browser_name"), "journey")
    ids = cut(b.where(F.col("event_id").isNotNull()).select("event_id").distinct(), "journey-events")
    l = only(location.select("event_id", "page_url_path", "utm_medium", "utm_source", "utm_content",
                             "utm_campaign"), "event_id", ids)
    return (b.join(l, "event_id")
            .select("click_id", "event_id", "event_timestamp", "browser_name", "page_url_path",
                    "utm_medium", "utm_source", "utm_content", "utm_campaign")
            .orderBy("event_timestamp", "event_id"))


def ip_sessions(geo: DataFrame, device: DataFrame, browser: DataFrame,
                top: int | None = 5) -> DataFrame:
    """Per ip address, the number of distinct (session, domain id, custom id)
    combinations seen with browser activity; most first, ``top`` rows.

    The defining query groups the geo x device x browser join by
    (ip, session, domain id, custom id) and then counts groups; that is a
    count of distinct tuples, so each side is reduced to distinct keys first and
    the browser side is a semi join -- no per-session product is formed.
    """
    g = geo.select("click_id", "ip_address").distinct()
    d = device.select("click_id", "user_domain_id", "user_custom_id").distinct()
    b = browser.select("click_id")
    t = g.join(d, "click_id").join(b, "click_id", "left_semi")
    out = t.groupBy("ip_address").agg(F.count(F.lit(1)).alias("cnt"))
    out = out.orderBy(F.col("cnt").desc(), F.col("ip_address").asc_nulls_last())
    return out.limit(top) if top else out


def ip_detail(geo: DataFrame, device: DataFrame, browser: DataFrame, ip: str) -> DataFrame:
    """E5: for one ip, joined row counts per (ip, session, domain id, custom id,
    device type).

    count(*) of an inner join is the product of the per-key counts of its
    sides, so each side is counted per key first instead of materialising the
    join. The ip's sessions select the device and browser rows where they are
    read (``only``), so neither feed is shuffled unless the ip has very many.
    """
    g = cut(geo.where(F.col("ip_address") == ip)
            .groupBy("ip_address", "click_id").agg(F.count(F.lit(1)).alias("g_n")), "ip-sessions")
    sessions = g.where(F.col("click_id").isNotNull()).select("click_id")
    d = (only(device, "click_id", sessions)
         .groupBy("click_id", "user_domain_id", "user_custom_id", "device_type")
         .agg(F.count(F.lit(1)).alias("d_n")))
    b = only(browser.select("click_id"), "click_id", sessions).groupBy("click_id").agg(F.count(F.lit(1)).alias("b_n"))
    return (g.join(d, "click_id").join(b, "click_id")
            .select("ip_address", "click_id", "user_domain_id", "user_custom_id", "device_type",
                    (F.col("g_n") * F.col("d_n") * F.col("b_n")).alias("cnt")))


FUNNEL = ("product", "cart", "payment", "confirmation")  # steps, in order


def funnel_steps(path: str = "page_url_path") -> Column:
    """The number of the step a page is, from 0; null for other pages."""
    p = F.col(path)
    return (F.when(is_product(path), 0).when(p == "/cart", 1).when(p == "/payment", 2).when(is_confirmation(path), 3))


def session_funnel(transitions: DataFrame, devices: DataFrame, bucket: str = "hour") -> DataFrame:
    """Session funnel: per device type and step, the sessions that took all steps up to it in order, each strictly later
    than the one before.

    The earliest possible time of each step is enough: a session's time of a
    step is the first such page after its time of the step before. Pages are
    held per session, step and ``bucket`` of time. The next one is either in
    the bucket of the time before, where its own pages are looked at, or the
    first of the first bucket after it: no session's pages ever meet as a whole.
    """
    us, at = epoch_micros("event_timestamp").alias("us"), F.date_trunc(bucket, "event_timestamp").cast("timestamp_ntz").alias("bucket")
    pages = transitions.select("session_id", funnel_steps().alias("step"), at, us).where(
        F.col("step").isNotNull() & F.col("session_id").isNotNull() & F.col("us").isNotNull())
    pages = cut(pages.distinct(), "funnel-pages")
    firsts = cut(pages.groupBy("session_id", "step", "bucket").agg(F.min("us").alias("us")), "funnel-firsts")
    reached = firsts.where("step = 0").groupBy("session_id").agg(F.min_by("bucket", "us").alias("bucket"), F.min("us").alias("us"))
    steps = []
    for k in range(len(FUNNEL)):
        if k:
            before = steps[-1].select("session_id", F.col("bucket").alias("_bucket"), F.col("us").alias("_us"))
            same = pages.where(F.col("step") == k).join(before, (pages["session_id"] == before["session_id"]) & (F.col("bucket") == F.col("_bucket")))
            later = firsts.where(F.col("step") == k).join(before, firsts["session_id"] == before["session_id"]).where("bucket > _bucket")
            found = same.where("us > _us").select(pages["session_id"], "bucket", "us").union(later.select(firsts["session_id"], "bucket", "us"))
            reached = found.groupBy("session_id").agg(F.min_by("bucket", "us").alias("bucket"), F.min("us").alias("us"))
        steps.append(cut(reached, f"funnel-{FUNNEL[k]}"))
    every = reduce(DataFrame.union, [s.select("session_id", F.lit(k).alias("step"), F.lit(FUNNEL[k]).alias("name")) for k, s in enumerate(steps)])
    kinds = devices.select("session_id", "device_type").distinct()
    return every.join(kinds, "session_id").groupBy("device_type", "step", "name").agg(F.count("*").alias("sessions"))
