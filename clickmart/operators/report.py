"""Report operators: the dashboard's filters, pivots and summaries on the marts.

Only the final (small) report rows ever leave the cluster. pandas semantics
kept on purpose: ``groupby``/``pivot_table`` drop NULL keys, membership filters
match NULL when None is selected, empty pivot cells are 0.

Mart inputs (column names as the mart operators produce them):
events (event, date_part, os_name, device_type, browser_name, cnt),
purchases (date_part, cnt), conversions (utm_source, date_part, sm),
campaigns (utm_campaign, utm_medium, date_part, sm), products (product, cnt),
users_segments (os_name, device_type, utm_source, users),
users_purchases (device_type, utm_source, os_name, products).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import isin_nullsafe
from clickmart.session import cut

TimeLike = str | dt.datetime | dt.date


def _ts(v: TimeLike) -> Column:
    if isinstance(v, dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(v, dt.date):
        v = v.strftime("%Y-%m-%d 00:00:00")
    return F.lit(v).cast("timestamp_ntz")


def default_range(today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The dashboard default: the last seven days, both bounds at midnight."""
    today = today or dt.date.today()
    return today - dt.timedelta(days=7), today


def _bounds(start: TimeLike | None, end: TimeLike | None) -> tuple[Column, Column]:
    """Both ends of a range; the default range where one is not given."""
    if start is None or end is None:
        d_start, d_end = default_range()
        start = d_start if start is None else start
        end = d_end if end is None else end
    return _ts(start), _ts(end)


def date_range(df: DataFrame, start: TimeLike | None = None, end: TimeLike | None = None,
               col: str = "date_part") -> DataFrame:
    """``start <= col <= end`` (inclusive; with midnight bounds the last day
    contributes only its 00:00 hour). A plain range predicate, so it reaches
    the parquet scan of a stored mart."""
    return df.where(F.col(col).between(*_bounds(start, end)))


def distinct_values(events: DataFrame, campaigns: DataFrame, users_segments: DataFrame,
                    start: TimeLike | None = None, end: TimeLike | None = None) -> DataFrame:
    """R2: filter options as (field, value) rows, NULL kept as a value.
    os/device/browser come from the whole events mart, events and campaigns from
    the date-filtered marts, sources from the user segments. The events mart is
    read once, its options exploded from each row."""
    ev_range = date_range(events, start, end)
    pair = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
    lo, hi = _bounds(start, end)
    options = F.array(pair("os_name"), pair("device_type"), pair("browser_name"),
                      F.when(F.col("date_part").between(lo, hi), pair("event")))
    parts = [events.select(F.explode(options).alias("option")).where(F.col("option").isNotNull()).select("option.*"),
             date_range(campaigns, start, end).select(pair("utm_campaign").alias("option")).select("option.*"),
             users_segments.select(pair("utm_source").alias("option")).select("option.*")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def multi_filter(df: DataFrame, **selected: Sequence | None) -> DataFrame:
    """AND of null-safe membership filters, e.g.
    ``multi_filter(events, event=[...], os_name=[...])``; None = no filter."""
    cond = F.lit(True)
    for col, values in selected.items():
        if values is not None:
            cond = cond & isin_nullsafe(col, values)
    return df.where(cond)


def pivot_sum(df: DataFrame, index: str, column: str, value: str,
              values: Sequence[str] | None = None) -> DataFrame:
    """index x column -> sum(value), NULL column keys dropped, empty cells 0.
    Pass ``values`` (the pivot columns) to avoid Spark's extra distinct pass."""
    kept = df.where(F.col(column).isNotNull() & F.col(index).isNotNull())
    if values is not None and not values:
        return kept.where(F.lit(False)).select(index)
    g = kept.groupBy(index)
    p = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    out = p.agg(F.sum(value))
    cols = [c for c in out.columns if c != index]
    return out.select(index, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(c)
                               for c in cols])


def events_pivot(events: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Hour x event label -> sum(cnt)."""
    return pivot_sum(events, "date_part", "event", "cnt", labels)


def events_detail(events: DataFrame) -> DataFrame:
    """Filtered rows, newest hour first."""
    return events.orderBy(F.col("date_part").desc())


def sales_hourly(purchases: DataFrame, start: TimeLike | None = None,
                 end: TimeLike | None = None) -> DataFrame:
    """Products bought per hour in the range, in time order."""
    return date_range(purchases, start, end).orderBy("date_part")


def sales_trend(purchases: DataFrame, start: TimeLike | None = None,
                end: TimeLike | None = None) -> DataFrame:
    """Least-squares line of cnt against the row index 0..n-1 (hour order),
    with the fitted value per hour.

    The index is a global row number, so this runs in one partition; its input
    is the hourly mart (one row per hour in the range), bounded by the length
    of the range, not by data volume.
    """
    w = Window.orderBy("date_part")
    r = date_range(purchases, start, end).select(
        "date_part", F.col("cnt").cast("long").alias("cnt"),
        (F.row_number().over(w) - 1).alias("idx"))
    whole = Window.partitionBy()
    y, x = F.col("cnt").cast("double"), F.col("idx").cast("double")
    fit = r.select("date_part", "cnt", "idx",
                   F.regr_slope(y, x).over(whole).alias("slope"),
                   F.regr_intercept(y, x).over(whole).alias("intercept"))
    return fit.select("date_part", "cnt", "idx",
                      F.round(F.col("intercept") + F.col("slope") * F.col("idx"), 6).alias("trend"))


def sales_kpis(purchases: DataFrame, start: TimeLike | None = None,
               end: TimeLike | None = None) -> DataFrame:
    """Total, mean and maximum hourly sales; no row for an empty range."""
    r = date_range(purchases, start, end)
    return (r.agg(F.count(F.lit(1)).alias("_n"), F.sum("cnt").cast("long").alias("total_sales"),
                  F.avg("cnt").alias("avg_sales"), F.max("cnt").cast("long").alias("max_sales"))
            .where("_n > 0").drop("_n"))


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    """The n most visited products (ties broken by product name), renamed
    for display."""
    return (products.orderBy(F.col("cnt").desc(), F.col("product").asc_nulls_last())
            .limit(n).select("product", F.col("cnt").alias("views")))


def _with_share(df: DataFrame, value: str) -> DataFrame:
    """Percent of the column total, one decimal. The groups are stored, the
    total is a partial aggregate over them and a scalar to each of them; no
    task holds all groups."""
    df = cut(df, f"share-{value}")
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn("share", F.round(F.lit(100.0) * F.col(value) / total, 1))


def source_totals(conversions: DataFrame, start: TimeLike | None = None,
                  end: TimeLike | None = None) -> DataFrame:
    """Products bought per utm_source in the range, with percent share."""
    g = (date_range(conversions, start, end).where(F.col("utm_source").isNotNull())
         .groupBy("utm_source").agg(F.sum("sm").cast("long").alias("sm")))
    return _with_share(g, "sm")


def source_pivot(conversions: DataFrame, sources: Sequence[str] | None = None,
                 start: TimeLike | None = None, end: TimeLike | None = None) -> DataFrame:
    """Hour x utm_source -> sum(sm).

    Without a list every source of the range is a column: the range is stored,
    its sources are listed (as many as the result has columns, without the
    limit of an inferred pivot) and then summed up.
    """
    kept = date_range(conversions, start, end)
    if sources is None:
        kept = cut(kept, "source-pivot")
        names = kept.select("utm_source").where(F.col("utm_source").isNotNull()).distinct()
        sources = sorted(r[0] for r in names.collect())
    return pivot_sum(kept, "date_part", "utm_source", "sm", sources)


def users_filter(df: DataFrame, os_names: Sequence | None = None, device_types: Sequence | None = None,
                 sources: Sequence | None = None) -> DataFrame:
    return multi_filter(df, os_name=os_names, device_type=device_types, utm_source=sources)


def users_by_source(users_segments: DataFrame, os_names=None, device_types=None,
                    sources=None) -> DataFrame:
    """Distinct users summed per utm_source, with percent share (a user in
    two segments counts twice)."""
    g = (users_filter(users_segments, os_names, device_types, sources)
         .where(F.col("utm_source").isNotNull())
         .groupBy("utm_source").agg(F.sum("users").cast("long").alias("users")))
    return _with_share(g, "users")


def first_campaigns(campaigns: DataFrame, k: int = 2) -> list[str]:
    """Default campaign selection: the first k campaign names (a bounded action)."""
    rows = (campaigns.where(F.col("utm_campaign").isNotNull()).select("utm_campaign")
            .distinct().orderBy("utm_campaign").limit(k).collect())
    return [r[0] for r in rows]


def campaign_pivot(campaigns: DataFrame, selected: Sequence[str] | None = None,
                   start: TimeLike | None = None, end: TimeLike | None = None) -> DataFrame:
    """Hour x campaign -> sum(sm) for the selected campaigns."""
    r = date_range(campaigns, start, end)
    selected = list(selected) if selected is not None else first_campaigns(r)
    r = r.where(isin_nullsafe("utm_campaign", selected))
    return pivot_sum(r, "date_part", "utm_campaign", "sm", [s for s in selected if s is not None])


def campaign_comparison(campaigns: DataFrame, selected: Sequence[str] | None = None,
                        start: TimeLike | None = None, end: TimeLike | None = None) -> DataFrame:
    """Per selected campaign: sum, mean and count of hourly sums."""
    r = date_range(campaigns, start, end)
    selected = list(selected) if selected is not None else first_campaigns(r)
    return (r.where(isin_nullsafe("utm_campaign", selected))
            .where(F.col("utm_campaign").isNotNull())
            .groupBy("utm_campaign")
            .agg(F.sum("sm").cast("long").alias("sum"), F.avg("sm").alias("mean"),
                 F.count("sm").alias("count")))


def users_by_os_device(users_segments: DataFrame, os_names=None, device_types=None,
                       sources=None) -> DataFrame:
    """Distinct users summed per (os, device type)."""
    return (users_filter(users_segments, os_names, device_types, sources)
            .where(F.col("os_name").isNotNull() & F.col("device_type").isNotNull())
            .groupBy("os_name", "device_type").agg(F.sum("users").cast("long").alias("users")))


def products_by_source(users_purchases: DataFrame, os_names=None, device_types=None,
                       sources=None) -> DataFrame:
    """Products bought per utm_source."""
    return (users_filter(users_purchases, os_names, device_types, sources)
            .where(F.col("utm_source").isNotNull())
            .groupBy("utm_source").agg(F.sum("products").cast("long").alias("products")))


def overall_kpis(events: DataFrame, purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Total events, total products bought and number of products; unfiltered.
    The three marts are stacked into one column set and aggregated once."""
    none = F.lit(None).cast("long")
    stacked = (events.select(F.col("cnt").cast("long").alias("e"), none.alias("p"), F.lit(0).alias("n"))
               .unionByName(purchases.select(none.alias("e"), F.col("cnt").cast("long").alias("p"),
                                             F.lit(0).alias("n")))
               .unionByName(products.select(none.alias("e"), none.alias("p"), F.lit(1).alias("n"))))
    return stacked.agg(F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("total_events"),
                       F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("total_purchases"),
                       F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_products"))
