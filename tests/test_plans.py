"""Physical-plan checks: pushdown, pruning and no quadratic joins."""

from __future__ import annotations

import tempfile

import pytest

import __spark_entry__ as E
from clickmart.plans import load_queries
from clickmart.plans.queries import REGISTRY
from clickmart.operators import marts, report, stage
from clickmart.plans.lake import Lake

SF = "/root/testdata/sf0.001"


def plan_text(df, mode="formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="clickmart-plans-")
    k = Lake.from_dir(spark, SF)
    for f in ("location_events", "browser_events"):
        k.feeds[f].write.parquet(f"{root}/{f}")
    return root


def test_product_filter_and_columns_reach_the_scan(spark, stored):
    loc = spark.read.parquet(f"{stored}/location_events")
    br = spark.read.parquet(f"{stored}/browser_events")
    txt = plan_text(marts.top_products(stage.transitions(br, loc)))
    assert "StringStartsWith(page_url_path,/product)" in txt
    assert "ReadSchema: struct<event_id:string,page_url_path:string>" in txt
    assert "ReadSchema: struct<event_id:string>" in txt


def test_date_range_reaches_the_scan(spark, stored):
    br = spark.read.parquet(f"{stored}/browser_events")
    loc = spark.read.parquet(f"{stored}/location_events")
    path = f"{stored}/m4"
    marts.products_purchased_hourly(stage.purchases(br, loc)).write.parquet(path)
    txt = plan_text(report.sales_hourly(spark.read.parquet(path), "2024-01-08", "2024-01-15"))
    assert "GreaterThanOrEqual(date_part,2024-01-08T00:00)" in txt
    assert "LessThanOrEqual(date_part,2024-01-15T00:00)" in txt


def test_purchases_uses_range_windows_not_nested_loops(spark):
    k = Lake.from_dir(spark, SF)
    txt = plan_text(k.stage["purchases"], "simple")
    assert "RangeFrame, unboundedpreceding$(), -1" in txt
    assert "NestedLoopJoin" not in txt and "CartesianProduct" not in txt


@pytest.mark.parametrize("name", sorted(REGISTRY.keys() - load_queries.REGISTRY.keys()))  # those return stored tables
def test_no_quadratic_join_operators(spark, name):
    txt = plan_text(E.queries()[name](spark, SF), "simple")
    assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt


def _count(txt: str, *names: str) -> int:
    return sum(line.lstrip(" :+-*0123456789()").startswith(names) for line in txt.splitlines())


def _initial(df) -> str:
    txt = plan_text(df, "simple")
    return txt.split("== Initial Plan ==")[-1]


def test_purchases_plan_reads_and_shuffles_little(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        txt = _initial(Lake.from_dir(spark, SF).stage["purchases"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _count(txt, "FileScan", "Scan") <= 4 and _count(txt, "Exchange") <= 14, txt


def test_event_distribution_shuffles_each_feed_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        txt = _initial(Lake.from_dir(spark, SF).marts["events_distribution_hourly"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _count(txt, "Exchange") <= 7, txt  # one per feed, two session aggregates and their join, the result


def test_hot_session_is_split_by_minute(spark):
    """60 % of the rows are one session within one hour: buckets stay small, results equal one window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from clickmart.operators.prefix import DEFAULT_BUCKETS, MINUTE_US, strictly_earlier

    df = spark.range(10_000).select(
        F.when(F.col("id") < 6000, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") < 6000, F.col("id") * 600_000).otherwise(F.col("id") * MINUTE_US * 7).alias("us"),
        (F.col("id") % 3).alias("v"))
    assert DEFAULT_BUCKETS[0] == MINUTE_US
    assert df.groupBy("k", F.expr(f"us div {MINUTE_US}")).count().agg(F.max("count")).first()[0] == 100
    w = Window.partitionBy("k").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("o", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert strictly_earlier(df, "k", "us", "v", "sum", "o").select("k", "us", "v", "o").exceptAll(want).count() == 0
