"""Registered queries of loading, the ledger, the stream, and the hourly run.

Each one delivers the feeds of the ``events`` table as files of the landing or
source layout below the scratch folder (a file per feed and day, named by the
day's first hour), loads them into databases of its own and returns what the
operator is about.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators import explore, report
from clickmart.plans import incremental, pipeline
from clickmart.plans import params as P
from clickmart.session import scratch_path
from clickmart.sources import ingest, landing, ledger, schemas
from clickmart.sources.feeds import load_events
from clickmart.streaming.incremental import ingest_available

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[fn.__name__] = fn
    return fn


def _name() -> str:
    return f"clickmart_{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    return scratch_path(spark, "landing", uuid.uuid4().hex)


def _days(events: DataFrame) -> tuple[dt.datetime, dt.datetime]:
    """First hour of the first and of the last day."""
    return tuple(events.agg(*(f(F.date_trunc("day", "ts").cast("timestamp_ntz")) for f in (F.min, F.max))).first())


def _each_day(first: dt.datetime, last: dt.datetime) -> list[dt.datetime]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _lakehouse() -> incremental.Lakehouse:
    return incremental.Lakehouse(*(_name() for _ in range(4)))


@register
def ingest_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of one load: every event P.BROKEN_EVERY-th broken, the day after the last one missing."""
    events, root = load_events(spark, sf_dir), _root(spark)
    landing.deliver(events, root, broken=F.col("event_id") % P.BROKEN_EVERY == 0)
    first, last = _days(events)
    out = ingest.ingest_hours(spark, root, _each_day(first, last + dt.timedelta(days=1)), db=_name())
    return out.select("feed", "load_hour", "status", "rows", "corrupt_rows", "parsed_rows")


@register
def ingest_backfill_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three backfills: without the first day's odd events, with them, and with nothing new. The ledger of deliveries."""
    events, root, db = load_events(spark, sf_dir), _root(spark), _name()
    first, last = _days(events)
    in_first = F.col("ts") < F.lit(first + dt.timedelta(days=1)).cast("timestamp_ntz")
    landing.deliver(events.where(~in_first | (F.col("event_id") % 2 == 0)), root)
    ingest.ingest_pending(spark, root, first, last, db=db)
    landing.deliver(events.where(in_first), root)
    ingest.ingest_pending(spark, root, first, last, db=db)
    ingest.ingest_pending(spark, root, first, last, db=db)
    return ledger.current(spark, db).select("feed", "load_hour", "delivery", "rows", "loads")


@register
def ingest_hour_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path and state of every feed and day's first hour, one day too many, before anything is loaded."""
    events, root, db = load_events(spark, sf_dir), _root(spark), _name()
    landing.deliver(events, root)
    ingest.create_raw_tables(spark, db)
    first, last = _days(events)
    found = ledger.compare(ingest.deliveries(spark, root, first, last + dt.timedelta(days=1)), ledger.current(spark, db))
    return found.where(F.hour("load_hour") == 0).select("feed", "load_hour", F.substring_index("path", "/", -3).alias("path"), "state")


@register
def ingest_zip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location feed, loaded from zipped source files."""
    events, root, db = load_events(spark, sf_dir), _root(spark), _name()
    landing.deliver(events, root, layout="zip", feeds=["location_events"])
    first, last = _days(events)
    ingest.load(spark, root, {"location_events": _each_day(first, last)}, "zip", db)
    return ingest.read_raw(spark, db)["location_events"]


class Stopped(Exception):
    """What ends the second run of the stream."""


@register
def ingest_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: three runs of the stream. The second one ends after its batch is in the raw table and before it is in the
    checkpoint, the third one runs that batch again and takes what came since. Rows per feed."""
    events, root, db = load_events(spark, sf_dir), _root(spark), _name()
    first, last = _days(events)
    part = F.pmod(F.datediff("ts", F.lit(first)), F.lit(3))
    checkpoints = scratch_path(spark, "streams", db)
    landing.deliver(events.where(part == 0), root)
    ingest_available(spark, root, db=db, checkpoint_root=checkpoints)
    landing.deliver(events.where(part == 1), root)

    def stop(feed: str, batch: int) -> None:
        raise Stopped(f"{feed} ended in batch {batch}")

    for feed in schemas.FEEDS:
        try:
            ingest_available(spark, root, [feed], db, checkpoints, after_batch=stop)
        except Exception as e:
            if "Stopped" not in str(e):
                raise
    landing.deliver(events.where(part == 2), root)
    ingest_available(spark, root, db=db, checkpoint_root=checkpoints)
    return explore.source_counts(ingest.read_raw(spark, db))


@register
def ingest_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer and name of every table and view of a lakehouse that was just loaded, with its rows."""
    events, root, lake = load_events(spark, sf_dir), _root(spark), _lakehouse()
    landing.deliver(events, root)
    first, last = _days(events)
    pipeline.backfill(spark, root, first, last, hours=_each_day(first, last), raw_db=lake.raw, stage_db=lake.stage, mart_db=lake.mart)
    layer = {lake.raw: "raw", lake.stage: "stage", lake.mart: "mart"}
    listed = [(r["database"], r["table"]) for r in ingest.catalog_listing(spark).collect()]
    out = None
    for db, name in sorted(x for x in listed if x[0] in layer and pipeline.VERSION not in x[1]):
        n = spark.table(f"{db}.{name}").agg(F.count("*").alias("rows")).select(F.lit(layer[db]).alias("layer"), F.lit(name).alias("name"), "rows")
        out = n if out is None else out.unionByName(n)
    return out.where(~F.col("name").isin("deliveries", "replaced_keys"))


@register
def pipeline_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded from landing files, stage and marts rebuilt once. All marts as mart, key and value."""
    events, root, lake = load_events(spark, sf_dir), _root(spark), _lakehouse()
    landing.deliver(events, root)
    first, last = _days(events)
    pipeline.backfill(spark, root, first, last, hours=_each_day(first, last), raw_db=lake.raw, stage_db=lake.stage, mart_db=lake.mart)
    return incremental.long_form(pipeline.load_marts(spark, lake.mart, cache=False))


@register
def pipeline_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, each followed by a run over the sessions it touches. All marts as mart, key and value.

    First the first two thirds of the days, the first day in part; then the
    rest and the first day once more, whole; at last, in files of another hour,
    every seventh event of all days.
    """
    events, root, lake = load_events(spark, sf_dir), _root(spark), _lakehouse()
    first, last = _days(events)
    bound = first + dt.timedelta(days=(last - first).days * 2 // 3)
    before = lambda t: F.col("ts") < F.lit(t).cast("timestamp_ntz")
    late, in_first = F.col("event_id") % 7 == 3, before(first + dt.timedelta(days=1))
    landing.deliver(events.where(~late & before(bound) & (~in_first | (F.col("event_id") % 2 == 0))), root)
    incremental.backfill(spark, root, first, last + dt.timedelta(hours=1), lake=lake)
    landing.deliver(events.where(~late & (~before(bound) | in_first)), root)
    incremental.backfill(spark, root, first, last + dt.timedelta(hours=1), lake=lake)
    landing.deliver(events.where(late), root, hours_late=1)
    incremental.backfill(spark, root, first, last + dt.timedelta(hours=1), lake=lake)
    return incremental.long_form(pipeline.load_marts(spark, lake.mart, cache=False))


@register
def pipeline_run_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery hour (the first day's file) loaded, stage and marts built. All marts as mart, key and value."""
    events, root, lake = load_events(spark, sf_dir), _root(spark), _lakehouse()
    landing.deliver(events, root)
    pipeline.run_hour(spark, root, _days(events)[0], raw_db=lake.raw, stage_db=lake.stage, mart_db=lake.mart)
    return incremental.long_form(pipeline.load_marts(spark, lake.mart, cache=False))


@register
def report_cached_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly sales report from the cache, after a refresh that replaced the cached mart."""
    from clickmart.plans.lake import Lake

    lake, db = Lake.from_dir(spark, sf_dir), _name()
    ingest.create_layers(spark, [db])
    cache = pipeline.MartCache(spark, db)
    name = "purchased_products_count_hourly"
    rows = lake.marts[name]
    pipeline._save(rows.where(F.col("date_part") < F.lit(P.REPORT_START).cast("timestamp_ntz")), f"{db}.{name}")
    report.sales_hourly(cache[name], P.REPORT_START, P.REPORT_END).count()
    pipeline._save(rows, f"{db}.{name}")
    return report.sales_hourly(cache[name], P.REPORT_START, P.REPORT_END)
