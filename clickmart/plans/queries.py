"""The query registry: name -> (spark, sf_dir) -> DataFrame.

Each query reads the ``events`` table under ``sf_dir``, derives the four raw
feeds from it (narrow projections) and runs one operator of the inventory on
whole tables. Names follow the operator inventory (stage_*, mart_*,
explore_*, report_*).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators import explore, marts, report, stage
from clickmart.plans import load_queries, pipeline
from clickmart.plans import params as P
from clickmart.plans.lake import Lake
from clickmart.session import scratch_path
from clickmart.sources import ingest, schemas

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Lake], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Lake.from_dir(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


# ---- stage ---------------------------------------------------------------
@register("stage_conversion")
def _s1(k: Lake):
    return stage.conversion(k.browser, k.location)


@register("stage_devices")
def _s2(k: Lake):
    return stage.devices(k.device)


@register("stage_events")
def _s3(k: Lake):
    return stage.events(k.browser)


@register("stage_events_basic")
def _s3b(k: Lake):
    return stage.events_basic(k.browser)


@register("stage_geo")
def _s4(k: Lake):
    return stage.geo(k.geo)


@register("stage_purchases")
def _s5(k: Lake):
    return stage.purchases(k.browser, k.location)


@register("stage_session_info")
def _s6(k: Lake):
    return stage.session_info(k.browser)


@register("stage_transitions")
def _s7(k: Lake):
    return stage.transitions(k.browser, k.location)


@register("stage_transitions_basic")
def _s7b(k: Lake):
    return stage.transitions_basic(k.browser, k.location)


# ---- marts ---------------------------------------------------------------
@register("mart_campaign_purchases_hourly")
def _m1(k: Lake):
    return marts.campaign_purchases_hourly(k.stage["purchases"], k.stage["conversion"])


@register("mart_campaign_purchases_basic")
def _m1b(k: Lake):
    return marts.campaign_purchases_basic(k.stage["purchases"], k.stage["conversion"])


@register("mart_source_purchases_hourly")
def _m2(k: Lake):
    return marts.source_purchases_hourly(k.stage["purchases"], k.stage["conversion"])


@register("mart_events_distribution_hourly")
def _m3(k: Lake):
    return k.marts["events_distribution_hourly"]


@register("mart_events_distribution_basic")
def _m3b(k: Lake):
    return marts.events_distribution_basic_from_feeds(k.browser, k.location)


@register("mart_products_purchased_hourly")
def _m4(k: Lake):
    return marts.products_purchased_hourly(k.stage["purchases"])


@register("mart_top_products")
def _m5(k: Lake):
    return k.marts["top_performing_products"]


@register("mart_users_purchases_segments")
def _m6(k: Lake):
    return marts.users_purchases_segments(k.stage["purchases"], k.stage["devices"],
                                          k.stage["conversion"])


@register("mart_users_segments")
def _m7(k: Lake):
    return marts.users_segments(k.stage["devices"], k.stage["conversion"])


@register("mart_users_segments_merged")
def _m7_merged(k: Lake):
    """M7 from mergeable sets: exact bitmaps of users per hour and segment, united over all hours."""
    sets = marts.user_sets(k.stage["devices"], k.stage["conversion"], k.stage["events"], marts.user_numbers(k.stage["devices"]))
    return marts.users_segments_merged(sets)


@register("mart_users_segments_range")
def _m7_range(k: Lake):
    """M7 over the report's range of hours, from the same sets."""
    sets = marts.user_sets(k.stage["devices"], k.stage["conversion"], k.stage["events"], marts.user_numbers(k.stage["devices"]))
    return marts.users_segments_merged(sets, P.REPORT_START, P.REPORT_END)


# ---- exploration ---------------------------------------------------------
@register("explore_wide_events")
def _e1(k: Lake):
    return explore.wide_events(k.browser, k.device, k.geo, k.location)


@register("explore_source_counts")
def _e2(k: Lake):
    return explore.source_counts(k.feeds)


@register("explore_session_journey")
def _e3(k: Lake):
    return explore.session_journey(k.browser, k.location, P.JOURNEY_SESSION)


@register("explore_ip_sessions")
def _e4(k: Lake):
    return explore.ip_sessions(k.geo, k.device, k.browser, P.TOP_IPS)


@register("explore_ip_detail")
def _e5(k: Lake):
    return explore.ip_detail(k.geo, k.device, k.browser, P.DETAIL_IP)


@register("explore_session_funnel")
def _funnel(k: Lake):
    return explore.session_funnel(k.stage["transitions"], k.stage["devices"])


# ---- reports -------------------------------------------------------------
def _events_filtered(k: Lake) -> DataFrame:
    ev = report.date_range(k.marts["events_distribution_hourly"], P.REPORT_START, P.REPORT_END)
    return report.multi_filter(ev, event=P.FILTER_EVENTS, os_name=P.FILTER_OS,
                               browser_name=P.FILTER_BROWSERS)


@register("report_date_range")
def _r1(k: Lake):
    return report.date_range(k.marts["events_distribution_hourly"], P.REPORT_START, P.REPORT_END)


@register("report_distinct_values")
def _r2(k: Lake):
    m = k.marts
    return report.distinct_values(m["events_distribution_hourly"],
                                  m["campaign_purchase_analysis_hourly"],
                                  m["users_segments_agg"], P.REPORT_START, P.REPORT_END)


@register("report_multi_filter")
def _r3(k: Lake):
    return _events_filtered(k)


@register("report_events_pivot")
def _r4(k: Lake):
    return report.events_pivot(_events_filtered(k), [e for e in P.FILTER_EVENTS if e is not None])


@register("report_events_detail")
def _r5(k: Lake):
    return report.events_detail(_events_filtered(k))


@register("report_sales_hourly")
def _r6(k: Lake):
    return report.sales_hourly(k.marts["purchased_products_count_hourly"], P.REPORT_START, P.REPORT_END)


@register("report_sales_trend")
def _r7(k: Lake):
    return report.sales_trend(k.marts["purchased_products_count_hourly"], P.REPORT_START, P.REPORT_END)


@register("report_sales_kpis")
def _r8(k: Lake):
    return report.sales_kpis(k.marts["purchased_products_count_hourly"], P.REPORT_START, P.REPORT_END)


@register("report_top_products")
def _r9(k: Lake):
    return report.top_products(k.marts["top_performing_products"], P.TOP_N)


@register("report_source_totals")
def _r10(k: Lake):
    return report.source_totals(k.marts["click_conversion_rates_hourly"], P.REPORT_START, P.REPORT_END)


@register("report_source_pivot")
def _r11(k: Lake):
    return report.source_pivot(k.marts["click_conversion_rates_hourly"], None, P.REPORT_START, P.REPORT_END)


@register("report_users_by_source")
def _r12(k: Lake):
    return report.users_by_source(k.marts["users_segments_agg"], P.USERS_OS, None, P.USERS_SOURCES)


@register("report_campaign_pivot")
def _r13(k: Lake):
    return report.campaign_pivot(k.marts["campaign_purchase_analysis_hourly"], P.CAMPAIGNS,
                                 P.REPORT_START, P.REPORT_END)


@register("report_campaign_comparison")
def _r14(k: Lake):
    return report.campaign_comparison(k.marts["campaign_purchase_analysis_hourly"], P.CAMPAIGNS,
                                      P.REPORT_START, P.REPORT_END)


@register("report_users_by_os_device")
def _r15(k: Lake):
    return report.users_by_os_device(k.marts["users_segments_agg"], P.USERS_OS, None, P.USERS_SOURCES)


@register("report_products_by_source")
def _r16(k: Lake):
    return report.products_by_source(k.marts["users_purchases_segments_agg"], P.USERS_OS, None,
                                     P.USERS_SOURCES)


@register("report_overall_kpis")
def _r17(k: Lake):
    m = k.marts
    return report.overall_kpis(m["events_distribution_hourly"], m["purchased_products_count_hourly"],
                               m["top_performing_products"])


# ---- ingest ----------------------------------------------------------------
def _json_roundtrip(k: Lake, feeds) -> dict[str, DataFrame]:
    """Write the derived feeds as JSON lines below the shared checkpoint folder
    and read them back with the explicit schemas (the raw-ingest path)."""
    import uuid
    spark = k.browser.sparkSession
    base = scratch_path(spark, "ingest-json", uuid.uuid4().hex)
    out = {}
    for feed in feeds:
        path = f"{base}/{feed}"
        ingest.write_json_feed(k.feeds[feed], path)
        out[feed] = ingest.read_json_feed(spark, f"{path}/*.json", feed, keep_corrupt=False).drop(
            ingest.LOAD_HOUR, ingest.DELIVERY)
    return out


@register("ingest_json_feed_counts")
def _i2(k: Lake):
    """JSON-lines scan of every feed with an explicit schema, then rows per feed."""
    return explore.source_counts(_json_roundtrip(k, schemas.FEEDS))


@register("ingest_json_location_events")
def _i1(k: Lake):
    """The location feed read back from JSON lines, by name."""
    return _json_roundtrip(k, ["location_events"])["location_events"]


def _scratch_db() -> str:
    """A database name of its own for each call, so that calls do not overwrite each other."""
    import uuid
    return f"clickmart_{uuid.uuid4().hex}"


@register("ingest_raw_counts")
def _i7(k: Lake):
    """Every feed is delivered to the raw tables twice from JSON
    lines; a repeated delivery replaces itself. Rows per raw table."""
    import uuid
    spark = k.browser.sparkSession
    db, base = _scratch_db(), scratch_path(spark, "ingest-raw", uuid.uuid4().hex)
    ingest.create_raw_tables(spark, db)
    for feed in schemas.FEEDS:
        ingest.write_json_feed(k.feeds[feed], f"{base}/{feed}")
        delivered = ingest.read_json_feed(spark, f"{base}/{feed}/*.json", feed).withColumn(
            ingest.LOAD_HOUR, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        for _ in range(2):
            ingest.write_raw(delivered, feed, db)
    return explore.source_counts(ingest.read_raw(spark, db))


@register("pipeline_mart_counts")
def _p3(k: Lake):
    """Stage and mart tables are built and stored; rows per stored mart."""
    spark = k.browser.sparkSession
    stage_db, mart_db = _scratch_db(), _scratch_db()
    pipeline.build_marts(spark, pipeline.build_stage(spark, k.feeds, stage_db), db=mart_db)
    return explore.source_counts(pipeline.load_marts(spark, mart_db, cache=False))


@register("pipeline_campaign_purchases")
def _p3_campaigns(k: Lake):
    """The campaign mart, read from the table that the pipeline stored."""
    spark = k.browser.sparkSession
    stage_db, mart_db = _scratch_db(), _scratch_db()
    pipeline.build_marts(spark, pipeline.build_stage(spark, k.feeds, stage_db), db=mart_db)
    return pipeline.load_marts(spark, mart_db, cache=False)["campaign_purchase_analysis_hourly"]


REGISTRY.update(load_queries.REGISTRY)
