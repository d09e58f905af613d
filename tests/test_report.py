"""Report operators: pandas semantics for NULLs, pivots, ranges and shares."""

from __future__ import annotations

import datetime as dt

from clickmart.functions import isin_nullsafe
from clickmart.operators import report
from tests.conftest import rows

H = [dt.datetime(2024, 1, d, h) for d, h in ((7, 23), (8, 0), (8, 5), (15, 0), (15, 1))]


def _events(spark):
    return spark.createDataFrame(
        [("go home", H[1], "iOS", "Mobile", "Chrome", 3),
         ("add product", H[1], "iOS", "Mobile", "Chrome", 2),
         (None, H[2], "iOS", "Mobile", "Chrome", 5),
         ("go cart", H[3], None, "Mobile", "Safari", 1),
         ("go cart", H[4], "iOS", "Mobile", "Safari", 7),
         ("go home", H[0], "iOS", "Mobile", "Safari", 9)],
        "event string, date_part timestamp_ntz, os_name string, device_type string, "
        "browser_name string, cnt long")


def test_membership_with_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    assert rows(df.where(isin_nullsafe("v", ["a", None]))) == [("a",), (None,)]
    assert rows(df.where(isin_nullsafe("v", ["a"]))) == [("a",)]


def test_date_range_inclusive_midnight(spark):
    got = report.date_range(_events(spark), "2024-01-08 00:00:00", "2024-01-15 00:00:00")
    assert sorted(r.date_part for r in got.collect()) == [H[1], H[1], H[2], H[3]]


def test_pivot_drops_null_key_and_fills_zero(spark):
    ev = report.date_range(_events(spark), "2024-01-08", "2024-01-15")
    p = report.events_pivot(ev, ["go home", "add product", "go cart"])
    got = {r.date_part: (r["go home"], r["add product"], r["go cart"]) for r in p.collect()}
    assert got == {H[1]: (3, 2, 0), H[3]: (0, 0, 1)}   # hour H[2] had only the NULL label


def test_multi_filter_and_kpis(spark):
    ev = report.multi_filter(_events(spark), event=["go cart", None], os_name=["iOS", None])
    assert rows(ev, "event", "cnt") == [("go cart", 1), ("go cart", 7), (None, 5)]
    sales = spark.createDataFrame([(H[1], 4), (H[2], 6)], "date_part timestamp_ntz, cnt long")
    k = report.sales_kpis(sales, "2024-01-08", "2024-01-15").first()
    assert (k.total_sales, k.avg_sales, k.max_sales) == (10, 5.0, 6)
    assert report.sales_kpis(sales, "2023-01-01", "2023-01-02").count() == 0


def test_trend_is_least_squares_on_row_index(spark):
    sales = spark.createDataFrame([(H[1], 1), (H[2], 3), (H[3], 5)], "date_part timestamp_ntz, cnt long")
    got = [(r.idx, r.trend) for r in report.sales_trend(sales, "2024-01-08", "2024-01-15")
           .orderBy("idx").collect()]
    assert got == [(0, 1.0), (1, 3.0), (2, 5.0)]


def test_top_products_ties_by_name(spark):
    prods = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "product string, cnt long")
    assert [tuple(r) for r in report.top_products(prods, 3).collect()] == [("c", 9), ("a", 5), ("b", 5)]


def test_shares_exclude_null_source(spark):
    conv = spark.createDataFrame([("google", H[1], 3), ("bing", H[1], 1), (None, H[1], 100)],
                                 "utm_source string, date_part timestamp_ntz, sm long")
    got = rows(report.source_totals(conv, "2024-01-08", "2024-01-15"))
    assert got == [("bing", 1, 25.0), ("google", 3, 75.0)]


def test_overall_kpis_on_empty_marts(spark):
    ev = _events(spark).limit(0)
    sales = spark.createDataFrame([], "date_part timestamp_ntz, cnt long")
    prods = spark.createDataFrame([("a", 1)], "product string, cnt long")
    assert tuple(report.overall_kpis(ev, sales, prods).first()) == (0, 0, 1)


def test_campaign_default_selection(spark):
    camp = spark.createDataFrame(
        [("campaign_2", "cpc", H[1], 1), ("campaign_0", "cpc", H[1], 2),
         ("campaign_1", "cpc", H[2], 3), (None, "cpc", H[2], 4)],
        "utm_campaign string, utm_medium string, date_part timestamp_ntz, sm long")
    cmp = report.campaign_comparison(camp, None, "2024-01-08", "2024-01-15")
    assert rows(cmp, "utm_campaign", "sum", "count") == [("campaign_0", 2, 1), ("campaign_1", 3, 1)]
