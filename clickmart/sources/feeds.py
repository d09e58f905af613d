"""The four raw feeds derived from the driver's ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` carries one row per
click; every feed is a narrow projection of it (no shuffle), so the feeds grow
with the table and keep its partitioning. Sessions are user-days.

The projections are Spark SQL expression lists (``selectExpr``): they are
parsed on the JVM in one call per feed instead of one Python round trip per
column function.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clickmart.sources import schemas

# Fixed values of the derivation (they must match the oracle SQL exactly).
EVENT_ID_PREFIX = "00000000-0000-4000-8000-"
SESSION_ID_PREFIX = "00000000-0000-4000-9000-"
PAGE_URL_PREFIX = "http://shop.example.com/"
BROWSERS = ("Chrome", "Firefox", "Safari")            # by user_id % 3
LANGUAGES = ("en_US", "de_DE")                        # by user_id % 2
REFERER_URLS = ("www.a.example", "www.b.example", "www.c.example")   # by k % 3
REFERER_MEDIA = ("internal", "search")                # by k % 2
UTM_MEDIA = ("organic", "cpc", "email")               # by k % 3
UTM_SOURCES = ("facebook", "google", "bing", None)    # by k % 4 (3 -> NULL)
OS_NAMES = ("iOS", "Android", "Windows", "Linux")     # by user_id % 4
TIMEZONE = "Europe/Berlin"


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _pick(n: str, values: tuple) -> str:
    """``CASE n WHEN 0 THEN values[0] ... ELSE values[-1] END``; a trailing None
    means no ELSE (NULL)."""
    *head, last = values
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(head))
    tail = "" if last is None else f" ELSE {_q(last)}"
    return f"CASE {n} {whens}{tail} END"


def _txt(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _uuid(prefix: str, n: str) -> str:
    return f"concat({_q(prefix)}, lpad({_txt(n)}, 12, '0'))"


_K = "try_cast(regexp_extract(props, '([0-9]+)', 1) AS INT)"
_SID = _uuid(SESSION_ID_PREFIX, "user_id * 100 + day(ts)")
_EID = _uuid(EVENT_ID_PREFIX, "event_id")

_PATH = ("CASE event_type WHEN 'view' THEN concat('/product_', " + _txt("k % 20") + ") "
         "WHEN 'purchase' THEN '/confirmation' WHEN 'signup' THEN '/payment' "
         "WHEN 'click' THEN (CASE WHEN k % 2 = 0 THEN '/home' ELSE '/cart' END) "
         "ELSE '/error' END")

FEED_EXPRESSIONS: dict[str, dict[str, str]] = {
    "browser_events": {
        "event_id": _EID,
        "event_timestamp": "ts",
        "event_type": "'pageview'",
        "click_id": _SID,
        "browser_name": _pick("user_id % 3", BROWSERS),
        "browser_user_agent": f"concat('UA/', {_txt('user_id % 7')})",
        "browser_language": _pick("user_id % 2", LANGUAGES),
    },
    "location_events": {
        "event_id": _EID,
        "page_url": f"concat({_q(PAGE_URL_PREFIX)}, {_txt('k')})",
        "page_url_path": _PATH,
        "referer_url": _pick("k % 3", REFERER_URLS),
        "referer_medium": _pick("k % 2", REFERER_MEDIA),
        "utm_medium": _pick("k % 3", UTM_MEDIA),
        "utm_source": _pick("k % 4", UTM_SOURCES),
        "utm_content": f"concat('ad_', {_txt('k % 5')})",
        "utm_campaign": f"concat('campaign_', {_txt('k % 6')})",
    },
    "device_events": {
        "click_id": _SID,
        "os": f"concat('os-', {_txt('user_id % 11')})",
        "os_name": _pick("user_id % 4", OS_NAMES),
        "os_timezone": _q(TIMEZONE),
        "device_type": "CASE WHEN user_id % 4 < 2 THEN 'Mobile' ELSE 'Computer' END",
        "device_is_mobile": "user_id % 4 < 2",
        "user_custom_id": f"concat('u', {_txt('user_id')}, '@example.com')",
        "user_domain_id": _uuid(EVENT_ID_PREFIX, "user_id"),
    },
    "geo_events": {
        "click_id": _SID,
        "geo_latitude": _txt("user_id % 90"),
        "geo_longitude": _txt("user_id % 180"),
        "geo_country": "CASE WHEN user_id % 3 = 0 THEN 'DE' ELSE 'US' END",
        "geo_timezone": _q(TIMEZONE),
        "geo_region_name": f"concat('R', {_txt('user_id % 9')})",
        "ip_address": f"concat('10.0.0.', {_txt('user_id % 50')})",
    },
}


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def feed_from_events(events: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One feed as a narrow projection of ``events``, columns in schema order
    (plus the ``keep`` columns of ``events``, passed through)."""
    exprs = FEED_EXPRESSIONS[name]
    cols = [f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schemas.FEED_SCHEMAS[name].fields]
    src = events.selectExpr("*", f"{_K} AS k") if name == "location_events" else events
    return src.selectExpr(*cols, *keep)


def feeds_from_events(events: DataFrame) -> Mapping[str, DataFrame]:
    """All four feeds (built lazily on first access)."""
    from clickmart.plans.lake import LazyTables
    return LazyTables({name: (lambda n=name: feed_from_events(events, n)) for name in FEED_EXPRESSIONS})


def load_feeds(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return feeds_from_events(load_events(spark, sf_dir))


def session_id_for(user_id: int, day: int) -> str:
    """Session id of one user-day, as the derivation builds it."""
    return f"{SESSION_ID_PREFIX}{user_id * 100 + day:012d}"
