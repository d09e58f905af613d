"""Explicit schemas for the four clickstream feeds.

Feeds are JSON lines whose key order varies, so they are always read with an
explicit StructType and matched by name; unknown keys are ignored and broken
lines land in ``_corrupt_record``. Ids are UUID text, kept as strings and
normalised to lower case on ingest (canonical lower-case UUID text orders like
the 128-bit value, so ``max(event_id)`` picks the same id as a UUID type).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

BROWSER_EVENTS = T.StructType([
    T.StructField("event_id", S),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_type", S),
    T.StructField("click_id", S),
    T.StructField("browser_name", S),
    T.StructField("browser_user_agent", S),
    T.StructField("browser_language", S),
])

LOCATION_EVENTS = T.StructType([
    T.StructField("event_id", S),
    T.StructField("page_url", S),
    T.StructField("page_url_path", S),
    T.StructField("referer_url", S),
    T.StructField("referer_medium", S),
    T.StructField("utm_medium", S),
    T.StructField("utm_source", S),
    T.StructField("utm_content", S),
    T.StructField("utm_campaign", S),
])

DEVICE_EVENTS = T.StructType([
    T.StructField("click_id", S),
    T.StructField("os", S),
    T.StructField("os_name", S),
    T.StructField("os_timezone", S),
    T.StructField("device_type", S),
    T.StructField("device_is_mobile", T.BooleanType()),
    T.StructField("user_custom_id", S),
    T.StructField("user_domain_id", S),
])

GEO_EVENTS = T.StructType([
    T.StructField("click_id", S),
    T.StructField("geo_latitude", S),
    T.StructField("geo_longitude", S),
    T.StructField("geo_country", S),
    T.StructField("geo_timezone", S),
    T.StructField("geo_region_name", S),
    T.StructField("ip_address", S),
])

FEED_SCHEMAS: dict[str, T.StructType] = {
    "browser_events": BROWSER_EVENTS,
    "device_events": DEVICE_EVENTS,
    "geo_events": GEO_EVENTS,
    "location_events": LOCATION_EVENTS,
}

FEEDS = tuple(FEED_SCHEMAS)

# UUID-typed columns per feed (normalised with lower(trim(x)) on ingest).
ID_COLUMNS: dict[str, tuple[str, ...]] = {
    "browser_events": ("event_id", "click_id"),
    "device_events": ("click_id",),
    "geo_events": ("click_id",),
    "location_events": ("event_id",),
}

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, S)])


def ddl(schema: T.StructType) -> str:
    """Column list usable in CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
