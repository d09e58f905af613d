"""Cross-operator invariants on the small driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickmart.operators import report
from clickmart.plans import params as P
from clickmart.plans.lake import Lake

SF = "/root/testdata/sf0.001"


def _total(df, col):
    return df.agg(F.coalesce(F.sum(col), F.lit(0))).first()[0]


def test_hourly_sales_sum_to_purchases(spark):
    k = Lake.from_dir(spark, SF)
    assert _total(k.marts["purchased_products_count_hourly"], "cnt") == \
        _total(k.stage["purchases"], "product_count")


def test_events_pivot_sums_to_unpivoted_total(spark):
    k = Lake.from_dir(spark, SF)
    ev = report.multi_filter(report.date_range(k.marts["events_distribution_hourly"],
                                               P.REPORT_START, P.REPORT_END),
                             event=P.FILTER_EVENTS, os_name=P.FILTER_OS)
    labels = [e for e in P.FILTER_EVENTS if e is not None]
    piv = report.events_pivot(ev, labels)
    pivot_total = piv.select(sum(F.col(f"`{c}`") for c in labels).alias("t")).agg(F.sum("t")).first()[0]
    assert pivot_total == _total(ev.where(F.col("event").isNotNull()), "cnt")


def test_source_pivot_and_totals_agree(spark):
    k = Lake.from_dir(spark, SF)
    conv = k.marts["click_conversion_rates_hourly"]
    piv = report.source_pivot(conv, P.SOURCES, P.REPORT_START, P.REPORT_END)
    tot = report.source_totals(conv, P.REPORT_START, P.REPORT_END)
    by_source = {r.utm_source: r.sm for r in tot.collect()}
    for s in P.SOURCES:
        assert _total(piv, f"`{s}`") == by_source.get(s, 0)
    shares = [r.share for r in tot.collect()]
    assert abs(sum(shares) - 100.0) < 0.2


def test_campaign_mart_sums_match_source_mart(spark):
    k = Lake.from_dir(spark, SF)
    assert _total(k.marts["campaign_purchase_analysis_hourly"], "sm") == \
        _total(k.marts["click_conversion_rates_hourly"], "sm")


def test_purchases_independent_of_bucket_width(spark):
    """Sessions span many hours: hourly buckets exercise the cross-bucket
    prefix on real data and must give exactly the day-bucket result."""
    from clickmart.operators import stage
    from clickmart.operators.prefix import HOUR_US
    k = Lake.from_dir(spark, SF)
    cols = ["session_id", "event_timestamp", "product_count"]
    day = stage.purchases(k.browser, k.location).select(*cols)
    hour = stage.purchases(k.browser, k.location, bucket_us=HOUR_US).select(*cols)
    minute = stage.purchases(k.browser, k.location, bucket_us=HOUR_US // 60).select(*cols)
    assert day.exceptAll(hour).count() == 0 and hour.exceptAll(day).count() == 0
    assert day.exceptAll(minute).count() == 0 and minute.exceptAll(day).count() == 0
