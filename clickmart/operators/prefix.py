"""Running aggregates over *strictly earlier* rows of a key, split so that no
key has to fit in one task.

A window ``PARTITION BY key ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND
1 PRECEDING`` sends every row of a key to one task; one bot session holding a
third of all clicks would then serialise the job. Here the order column is cut
into coarse buckets (``t div bucket``) and the aggregate is assembled from

* an in-bucket window partitioned by ``(key, bucket)`` (strictly earlier rows
  of the same bucket; equal ``t`` always share a bucket, so ties stay out), and
* a bucket prefix: the per-``(key, bucket)`` partial aggregate (map-side
  combined) rolled up over earlier buckets, one row per bucket, joined back;
  buckets are bucketed again, so a long history does not meet in one task.

A task therefore holds at most one bucket of one key; the widths are the knob
for pathological keys. Rows whose key or order is NULL take no part
(SQL ``=``/``<`` never match NULL); callers handle them separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US
# Widths of nested buckets: instants by minute, minutes by day, days by key.
DEFAULT_BUCKETS = (MINUTE_US, DAY_US // MINUTE_US)

_AGGS = {"sum": F.sum, "max": F.max}


def strictly_earlier(df: DataFrame, key: str, order: str, value: str, how: str,
                     out: str, bucket_us: int | Sequence[int] = DEFAULT_BUCKETS, shuffled: bool = False) -> DataFrame:
    """Add ``out`` = sum/max of ``value`` over rows with the same ``key`` and a
    strictly smaller ``order`` (a LONG, e.g. epoch micros).

    ``bucket_us`` holds the widths of nested buckets, finest first; the rows of a
    level are the buckets of the one below. ``sum`` yields 0 and ``max`` yields
    NULL when there is no earlier row. ``df`` must not contain NULL
    ``key``/``order`` values. ``shuffled``: sums of buckets are never sent from the driver.
    """
    agg = _AGGS[how]
    widths = (bucket_us,) if isinstance(bucket_us, int) else tuple(bucket_us)
    if not widths:
        w = Window.partitionBy(key).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
        all_before = agg(value).over(w)
        return df.withColumn(out, F.coalesce(all_before, F.lit(0)) if how == "sum" else all_before)
    b, total, local_, earlier = (f"_cm_{x}{len(widths)}" for x in ("bucket", "total", "local", "earlier"))
    rows = df.withColumn(b, F.expr(f"`{order}` div {int(widths[0])}"))

    w_in = (Window.partitionBy(key, b).orderBy(order)
            .rangeBetween(Window.unboundedPreceding, -1))
    local = rows.withColumn(local_, agg(value).over(w_in))
    sums = rows.groupBy(key, b).agg(agg(value).alias(total))
    before = strictly_earlier(sums, key, b, total, how, earlier, widths[1:], shuffled).select(key, b, earlier)
    before = before.hint("merge") if shuffled else before

    joined = local.join(before, [key, b], "left")
    if how == "sum":
        combined: Column = F.coalesce(F.col(local_), F.lit(0)) + F.coalesce(F.col(earlier), F.lit(0))
    else:
        combined = F.greatest(F.col(local_), F.col(earlier))
    return joined.withColumn(out, combined).drop(b, local_, earlier)
