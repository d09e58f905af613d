"""Replacing a stored table: a failed write leaves the old rows, old versions go."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from clickmart import session
from clickmart.plans import pipeline
from clickmart.sources import ingest


def test_refresh_swaps_and_survives_a_failed_write(spark):
    ingest.create_layers(spark, ["refresh"])
    spark.range(3).write.format("parquet").saveAsTable("refresh.t")  # as earlier runs left it
    pipeline._save(spark.range(5), "refresh.t")
    reader = spark.table("refresh.t")
    assert reader.count() == 5
    with pytest.raises(Exception, match="broken"):
        pipeline._save(spark.range(7).select(F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id")),
                       "refresh.t")
    assert spark.table("refresh.t").count() == 5
    pipeline._save(spark.range(9), "refresh.t")
    assert spark.table("refresh.t").count() == 9 and reader.count() == 5
    pipeline._save(spark.range(2).withColumn("more", F.lit(1)), "refresh.t")
    assert spark.table("refresh.t").columns == ["id", "more"]
    assert sum("__v" in t.name for t in spark.catalog.listTables("refresh")) == 2


def test_marts_move_together(spark):
    ingest.create_layers(spark, ["together"])
    pipeline.save_together({"together.a": spark.range(1), "together.b": spark.range(1)})
    broken = spark.range(7).select(F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        pipeline.save_together({"together.a": spark.range(2), "together.b": broken})
    assert spark.table("together.a").count() == spark.table("together.b").count() == 1
    pipeline.save_together({"together.a": spark.range(3), "together.b": spark.range(4)})
    assert (spark.table("together.a").count(), spark.table("together.b").count()) == (3, 4)


def test_scratch_is_swept(spark):
    kind = f"sweep-{uuid.uuid4().hex}"
    for name in "ab":
        spark.range(3).write.parquet(session.scratch_path(spark, kind, name))
    assert session.sweep(spark, 24, [kind]) == 0
    assert spark.read.parquet(session.scratch_path(spark, kind, "a")).count() == 3
    assert session.sweep(spark, -1, [kind]) == 2 and session.sweep(spark, -1, [kind]) == 0


def test_marts_send_no_session_table_to_all_tasks(spark, monkeypatch):
    """Files of session tables are small and their rows are not: what is small enough here must still be shuffled."""
    texts = "session_id string, os_name string, device_type string, utm_campaign string, utm_medium string, utm_source string, " \
            "user_custom_id string, page_url_path string, browser_name string, event_timestamp timestamp_ntz, product_count long"
    stored = session.cut(spark.createDataFrame([("s", "iOS", "Mobile", "c", "m", "a", "u", "/product_1", "Chrome", None, 1)], texts), "sent")
    made = {}
    monkeypatch.setattr(pipeline, "save_together", lambda tables: made.update(tables) or dict(tables))
    pipeline.build_marts(spark, dict.fromkeys(pipeline.STAGE_TABLES, stored), db="sent")
    assert len(made) == len(pipeline.MART_TABLES)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in made.values()]
    assert sum("SortMergeJoin" in p for p in plans) == 5
    assert not any("Broadcast" in p for p in plans)
    assert {name.split(".")[1]: df.count() for name, df in made.items()} == dict.fromkeys(pipeline.MART_TABLES, 1)
