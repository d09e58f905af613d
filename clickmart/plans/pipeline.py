"""The hourly pipeline: ingest -> stage -> marts, all as Spark jobs.

* ``build_stage`` (P2) rebuilds the seven stage tables from the raw tables.
  The browser x location join is written once (as ``stage.transitions``) and
  purchases and attribution are derived from that table instead of joining
  the raw feeds again.
* ``build_marts`` (P3) rebuilds the seven marts from the stage tables.
* ``run_hour`` (P1) loads one delivery hour of the four feeds, then rebuilds.
* ``backfill`` (P4) loads a range of hours in one job per feed, then rebuilds
  once.

Full rebuilds (like the definition): a late click can change the attribution
of its session and every later purchase row of that session, so partial
per-hour refreshes would be wrong (``plans.incremental`` recomputes whole
sessions instead). Each table is written anew and a view is
then pointed at it; writing a table is also what cuts the lineage between
layers, so a lost executor only recomputes from the last written table.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from clickmart.operators import stage
from clickmart.plans.lake import mart_tables
from clickmart.sources import ingest

STAGE_TABLES = ("transitions", "conversion", "devices", "events", "geo", "purchases", "session_info")
MART_TABLES = ("campaign_purchase_analysis_hourly", "click_conversion_rates_hourly",
               "events_distribution_hourly", "purchased_products_count_hourly",
               "top_performing_products", "users_segments_agg", "users_purchases_segments_agg")


VERSION = "__v"  # between a table's name and the time it was written


def _write(df: DataFrame, name: str) -> str:
    """Write ``df`` as a new version of the table ``name``; returns the version."""
    db, table = name.split(".")
    version = f"{db}.{table}{VERSION}{time.time_ns():020d}"
    df.write.format("parquet").saveAsTable(version)
    return version


def _point(spark: SparkSession, name: str, version: str) -> DataFrame:
    """Point the view ``name`` at a version, and drop all but the last two."""
    db, table = name.split(".")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a table from before there were versions
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    versions = sorted(t.name for t in spark.catalog.listTables(db, f"{table}{VERSION}*"))
    for old in versions[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{old}")
    return spark.table(version)


def _save(df: DataFrame, name: str) -> DataFrame:
    """Replace ``name`` with ``df`` and return the stored table.

    The rows go to a table of their own version, then the view ``name`` is
    pointed at it: a failed write leaves the old rows readable, and readers
    never find a gap. The replaced version stays for those who still read it;
    the ones before it go.
    """
    return _point(df.sparkSession, name, _write(df, name))


def save_together(tables: Mapping[str, DataFrame], at_once: int | None = None) -> dict[str, DataFrame]:
    """``_save`` for several tables: all are written, side by side (or ``at_once`` of them), before the first view moves. A failed
    write moves none, and readers see old and new versions together only while views are moved, not while
    tables are written."""
    names = list(tables)
    with ThreadPoolExecutor(at_once or max(1, len(names))) as pool:
        versions = list(pool.map(lambda name: _write(tables[name], name), names))
    return {name: _point(tables[name].sparkSession, name, version) for name, version in zip(names, versions, strict=True)}


def build_stage(spark: SparkSession, raw: Mapping[str, DataFrame], db: str = "stage") -> dict[str, DataFrame]:
    """Raw feeds -> stage tables (returns the stored tables)."""
    ingest.create_layers(spark, [db])
    b, loc = raw["browser_events"], raw["location_events"]
    out = {"transitions": _save(stage.transitions(b, loc), f"{db}.transitions")}
    tr = out["transitions"]
    out["purchases"] = _save(stage.purchases_from_events(tr), f"{db}.purchases")
    out["conversion"] = _save(stage.conversion_from_ids(tr.select("session_id", "event_id"), loc),
                              f"{db}.conversion")
    out["devices"] = _save(stage.devices(raw["device_events"]), f"{db}.devices")
    out["events"] = _save(stage.events(b), f"{db}.events")
    out["geo"] = _save(stage.geo(raw["geo_events"]), f"{db}.geo")
    out["session_info"] = _save(stage.session_info(b), f"{db}.session_info")
    return out


def joined_by_session(s: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage tables whose joins are shuffled. Rows of a session are stored so small that a table's files pass for something
    to send to all tasks, from the driver, where it is millions of sessions; and several marts do so side by side."""
    return {**s, **{name: s[name].hint("merge") for name in ("conversion", "devices")}}


def build_marts(spark: SparkSession, stage_tables: Mapping[str, DataFrame] | None = None,
                stage_db: str = "stage", db: str = "mart") -> dict[str, DataFrame]:
    """Stage tables -> marts (returns the stored tables)."""
    ingest.create_layers(spark, [db])
    s = stage_tables or {t: spark.table(f"{stage_db}.{t}") for t in STAGE_TABLES}
    marts = mart_tables(joined_by_session(s))
    saved = save_together({f"{db}.{name}": marts[name] for name in MART_TABLES})
    return {name: saved[f"{db}.{name}"] for name in MART_TABLES}


class MartCache:
    """The marts of a database, cached for repeated report queries.

    A cached mart belongs to the version its view pointed at. Each access looks
    where the view points now; if a refresh has moved it, the new version is
    cached and the blocks of the old one are released.
    """

    def __init__(self, spark: SparkSession, db: str = "mart"):
        self.spark, self.db = spark, db
        self.held: dict[str, tuple[str, DataFrame]] = {}

    def version(self, name: str) -> str:
        """The table that the mart's view reads."""
        for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.db}.{name}").collect():
            if r["col_name"] == "View Text":
                return r["data_type"].rsplit(" ", 1)[1]
        return f"{self.db}.{name}"  # a table from before there were versions

    def __getitem__(self, name: str) -> DataFrame:
        version = self.version(name)
        if name in self.held and self.held[name][0] == version:
            return self.held[name][1]
        self.release(name)
        self.held[name] = version, self.spark.table(version).cache()
        return self.held[name][1]

    def release(self, name: str) -> None:
        if name in self.held:
            self.held.pop(name)[1].unpersist()


def load_marts(spark: SparkSession, db: str = "mart", cache: bool = True) -> dict[str, DataFrame]:
    """The seven marts as they are now, cached or not (``MartCache`` follows refreshes)."""
    marts = MartCache(spark, db)
    return {name: marts[name] if cache else spark.table(f"{db}.{name}") for name in MART_TABLES}


def rebuild(spark: SparkSession, raw_db: str = "raw", stage_db: str = "stage", mart_db: str = "mart") -> dict[str, DataFrame]:
    raw = ingest.read_raw(spark, raw_db)
    st = build_stage(spark, raw, stage_db)
    return build_marts(spark, st, db=mart_db)


def run_hour(spark: SparkSession, root: str, hour: dt.datetime, layout: str = "landing", raw_db: str = "raw",
             stage_db: str = "stage", mart_db: str = "mart") -> DataFrame:
    """Load one hour of the four feeds (missing feeds are skipped), then
    rebuild stage and marts. Returns the load report."""
    report = ingest.ingest_hours(spark, root, [hour], layout, raw_db)
    rebuild(spark, raw_db, stage_db, mart_db)
    return report


def backfill(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime,
             layout: str = "landing", hours: Sequence[dt.datetime] | None = None, raw_db: str = "raw",
             stage_db: str = "stage", mart_db: str = "mart") -> DataFrame:
    """Load every hour from ``start`` to ``end`` (one read per feed over all
    of them), then rebuild once. Returns the load report. (``ingest.ingest_pending``
    loads only what the ledger lacks.)"""
    report = ingest.ingest_hours(spark, root, hours or ingest.hours_between(start, end), layout, raw_db)
    rebuild(spark, raw_db, stage_db, mart_db)
    return report
