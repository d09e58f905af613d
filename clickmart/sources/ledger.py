"""The ledger of deliveries: which file of which feed and hour was loaded when, with what result.

``{db}.deliveries`` has one row per load and feed-hour (a load is one call of the
loader, numbered by the time it began) and is only ever appended to; the last row
of a delivery says what the raw tables hold of it. A load is thus a join of the
files that are there with the ledger, and a backfill loads what differs.

``{db}.replaced_keys`` holds the keys (event and session) of rows that a load
replaces, written before it does: what depends on them can be found afterwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.sources import schemas

LOADED, SKIPPED = "loaded", "skipped"
NEW, CHANGED, KEPT, MISSING = "new", "changed", "kept", "missing"
COLUMNS = ("feed string, load_hour timestamp_ntz, delivery string, path string, size long, modified long, status string, "
           "rows long, corrupt_rows long, parsed_rows long")
KEYS = "feed string, event_id string, session_id string"


def create(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.deliveries ({COLUMNS}, load LONG) USING parquet PARTITIONED BY (load)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.replaced_keys ({KEYS}, load LONG) USING parquet PARTITIONED BY (load)")


def record(spark: SparkSession, db: str, load: int, rows: Sequence[tuple]) -> None:
    """Append the rows of one load (one small file)."""
    df = spark.createDataFrame(rows, COLUMNS).coalesce(1).withColumn("load", F.lit(load).cast("long"))
    df.write.mode("append").insertInto(f"{db}.deliveries")


def history(spark: SparkSession, db: str) -> DataFrame:
    spark.catalog.refreshTable(f"{db}.deliveries")
    return spark.table(f"{db}.deliveries")


def current(spark: SparkSession, db: str) -> DataFrame:
    """The last load that found a delivery, and how many did."""
    cols = [c.split()[0] for c in COLUMNS.split(", ")]
    keys = ("feed", "load_hour", "delivery")
    last = history(spark, db).where(F.col("status") == LOADED).groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in cols if c not in keys], "load"), "load").alias("last"), F.count("*").alias("loads"))
    return last.select(*keys, "last.*", "loads")


def compare(there: DataFrame, loaded: DataFrame) -> DataFrame:
    """``there`` (feed, load_hour, path, size, modified) with the state of each feed-hour against the ledger."""
    known = loaded.select("feed", "load_hour", "path", F.col("size").alias("_size"), F.col("modified").alias("_modified"), F.lit(True).alias("_known"))
    differs = (F.col("size") != F.col("_size")) | (F.col("modified") != F.col("_modified"))
    state = (F.when(F.col("modified").isNull(), MISSING).when(F.col("_known").isNull(), NEW)
             .when(differs, CHANGED).otherwise(KEPT))
    return there.join(known, ["feed", "load_hour", "path"], "left").select("feed", "load_hour", "path", "size", "modified", state.alias("state"))


def session_keys(feed: str, rows: DataFrame, *more: str) -> DataFrame:
    """feed, event_id and session_id of a feed's rows (null where it has none), and more columns."""
    has = {f.name for f in schemas.FEED_SCHEMAS[feed].fields}
    pick = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    return rows.select(F.lit(feed).alias("feed"), pick("event_id").alias("event_id"), pick("click_id").alias("session_id"), *more)


def keep_replaced(spark: SparkSession, db: str, load: int, wanted: Mapping[str, Sequence[tuple[dt.datetime, str]]]) -> None:
    """Write the keys of the rows that a load of these deliveries replaces."""
    before = {(r["feed"], r["load_hour"], r["delivery"]) for r in current(spark, db).where("rows > 0").select("feed", "load_hour", "delivery").collect()}
    parts = []
    for feed, deliveries in wanted.items():
        again = [d for d in deliveries if (feed, *d) in before]
        if again:
            spark.catalog.refreshTable(f"{db}.{feed}")
            old = spark.createDataFrame(again, "load_hour timestamp_ntz, delivery string")
            hours = sorted({h for h, _ in again})
            rows = spark.table(f"{db}.{feed}").where(F.col("load_hour").isin(hours)).join(F.broadcast(old), ["load_hour", "delivery"], "left_semi")
            parts.append(session_keys(feed, rows).distinct())
    if parts:
        keys = parts[0]
        for p in parts[1:]:
            keys = keys.unionByName(p)
        keys.withColumn("load", F.lit(load).cast("long")).write.mode("append").insertInto(f"{db}.replaced_keys")
