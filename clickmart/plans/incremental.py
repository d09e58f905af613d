"""The hourly run without a rebuild: only sessions that a delivery touches are computed anew.

A click can change the attribution of its session, every later purchase row of
it, and the rows of sessions that share an event id with it; nothing else. A run

1. takes the loads that the ledger has and no run has taken, and the keys of the
   rows they brought or replaced;
2. finds the sessions of these keys (a scan of two narrow columns of the raw
   feeds, for rows of the same event that came in other deliveries), and their
   neighbours, which share an event id with them (``shared_events``);
3. reads the raw rows of these sessions, from the delivery hours that
   ``session_hours`` names for them, and builds their stage rows with the same
   operators as the full build;
4. adds to each mart's ``_delta`` table what the marts of the new stage rows are
   over those of the old ones: every mart is a sum over sessions, so sums and
   row counts can be added and taken away (users: counted per user first);
5. swaps the sessions' rows into the stage tables. These are partitioned by
   ``home``, the delivery hour a session was first seen in, and only the homes
   of touched sessions are written anew;
6. sums the deltas up as the new version of each mart.

A run has the number of its last load. All it writes before step 5 goes to
partitions of that number, so a run that failed is run again from its start;
one that failed in step 5 goes on from its stored rows (``runs`` says which).
Steps 4 to 6 read no raw rows. Rows without a session (null) are one session.

The driver plans much and must hold little: joins whose sides grow with the data are
shuffled (``merge``), since stored keys are small files of many rows, and
``AT_ONCE`` tables of a layer are worked on at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import event_label, hour_start, is_product, product_name
from clickmart.operators import stage
from clickmart.plans.pipeline import MART_TABLES, STAGE_TABLES, joined_by_session, save_together
from clickmart.session import cut, discard, release, scratch_path
from clickmart.sources import ingest, ledger, schemas

SENT_KEYS = 100_000  # up to so many keys (of some 40 bytes) are sent to the tasks instead of shuffling what they select
AT_ONCE = 2  # tables worked on side by side: every query in flight has its plan, its threads and what it sends in the driver
BEGAN, COMPUTED, DONE = "began", "computed", "done"
STAGE_COLUMNS = {
    "transitions": "event_id STRING, session_id STRING, page_url STRING, browser_name STRING, page_url_path STRING, event_timestamp TIMESTAMP_NTZ",
    "conversion": "session_id STRING, referer_url STRING, referer_medium STRING, utm_medium STRING, utm_source STRING, utm_content STRING, utm_campaign STRING",
    "devices": "session_id STRING, os_name STRING, os_timezone STRING, device_type STRING, user_custom_id STRING, user_domain_id STRING",
    "events": "session_id STRING, event_id STRING, event_timestamp TIMESTAMP_NTZ, browser_name STRING",
    "geo": "session_id STRING, geo_latitude STRING, geo_longitude STRING, geo_country STRING, geo_timezone STRING, geo_region_name STRING, ip_address STRING",
    "purchases": "session_id STRING, event_timestamp TIMESTAMP_NTZ, product_count LONG",
    "session_info": "session_id STRING, browser_name STRING, browser_user_agent STRING, browser_language STRING",
}
# keys of each mart, in the order of its columns, and the name of its value; users_segments_agg counts its last key
MART_KEYS = {
    "campaign_purchase_analysis_hourly": (("utm_campaign", "utm_medium", "date_part"), "sm"),
    "click_conversion_rates_hourly": (("utm_source", "date_part"), "sm"),
    "events_distribution_hourly": (("event", "date_part", "os_name", "device_type", "browser_name"), "cnt"),
    "purchased_products_count_hourly": (("date_part",), "cnt"),
    "top_performing_products": (("product",), "cnt"),
    "users_segments_agg": (("os_name", "device_type", "utm_source", "user_custom_id"), "users"),
    "users_purchases_segments_agg": (("device_type", "utm_source", "os_name"), "products"),
}


@dataclass(frozen=True)
class Lakehouse:
    """The databases of one set of layers."""

    raw: str = "raw"
    stage: str = "stage"
    mart: str = "mart"
    state: str = "state"


def create(spark: SparkSession, lake: Lakehouse) -> None:
    ingest.create_raw_tables(spark, lake.raw)
    ingest.create_layers(spark, [lake.stage, lake.mart, lake.state])
    for name in STAGE_TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {lake.stage}.{name} ({STAGE_COLUMNS[name]}, home TIMESTAMP_NTZ) {ingest.REPLACEABLE} PARTITIONED BY (home)")
    tables = {"session_hours": "session_id STRING, feed STRING, load_hour TIMESTAMP_NTZ", "homes": "session_id STRING, home TIMESTAMP_NTZ",
              "shared_events": "event_id STRING, session_id STRING", "runs": "step STRING, loads ARRAY<BIGINT>, path STRING, at TIMESTAMP_NTZ"}
    for mart, (keys, _) in MART_KEYS.items():
        tables[f"{mart}_delta"] = ", ".join(f"{k} {'TIMESTAMP_NTZ' if k == 'date_part' else 'STRING'}" for k in keys) + ", value LONG, n LONG"
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {lake.state}.{name} ({columns}, run LONG) {ingest.REPLACEABLE} PARTITIONED BY (run)")


def _read(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _keep(df: DataFrame, table: str, run: int) -> None:
    """Make ``df`` the partition ``run`` of a state table (an empty one removes what was there)."""
    spark = df.sparkSession
    rows = df.withColumn("run", F.lit(run).cast("long")).select(*spark.table(table).columns)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run = {run})")
    rows.write.mode("overwrite").insertInto(table)


def _log(spark: SparkSession, lake: Lakehouse, run: int, step: str, loads: list[int], path: str | None) -> None:
    row = spark.createDataFrame([(step, loads, path)], "step string, loads array<bigint>, path string").coalesce(1)
    row.select("step", "loads", "path", F.current_timestamp().cast("timestamp_ntz").alias("at"), F.lit(run).cast("long").alias("run")).write.mode(
        "append").insertInto(f"{lake.state}.runs")


def _side_by_side(fn: Callable, *args: Iterable) -> list:
    """``fn`` for each of a layer's tables, ``AT_ONCE`` side by side."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(fn, *args))


def _sent(keys: DataFrame) -> DataFrame:
    """Stored keys (and what goes with them, after the first column) as a side of joins: few are sent to the tasks, so that
    the other side is filtered where it is read; many are joined by a shuffle, however small their files are."""
    keys = keys.withColumnRenamed(keys.columns[0], "_key")
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys.hint("merge")


def _of(df: DataFrame, keys: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose column is (or, left_anti, is not) among the keys (``_sent``), null equal to null; with what goes
    with the keys (inner)."""
    return df.join(keys, F.col(column).eqNullSafe(F.col("_key")), how).drop("_key")


def _hours(df: DataFrame, column: str) -> list:
    """The distinct hours of a column: as many as there are hours of deliveries, at most."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _loaded_rows(spark: SparkSession, lake: Lakehouse, loads: list[int]) -> dict[str, DataFrame]:
    """The raw rows that the deliveries of these loads brought."""
    found = ledger.history(spark, lake.raw).where(F.col("load").isin(loads) & (F.col("status") == ledger.LOADED))
    found = found.select("feed", "load_hour", "delivery").distinct().collect()
    out = {}
    for feed in schemas.FEEDS:
        own = [(r["load_hour"], r["delivery"]) for r in found if r["feed"] == feed]
        rows = _read(spark, f"{lake.raw}.{feed}").where(F.col("load_hour").isin(sorted({h for h, _ in own})))
        mine = spark.createDataFrame(own, "load_hour timestamp_ntz, delivery string")
        out[feed] = rows.join(F.broadcast(mine), ["load_hour", "delivery"], "left_semi")
    return out


def _neighbours(sessions: DataFrame, shared: DataFrame) -> DataFrame:
    """The sessions and those that share an event id with one of them."""
    if not shared.take(1):
        return sessions
    ids = cut(_of(shared, _sent(sessions), "session_id").select("event_id").distinct(), "neighbour-events")
    return sessions.union(_of(shared, _sent(ids), "event_id").select("session_id")).distinct()


def _touched(spark: SparkSession, lake: Lakehouse, run: int, loads: list[int]) -> tuple[DataFrame, DataFrame]:
    """(sessions whose rows change, sessions whose rows these are computed from); notes where their raw rows are."""
    new = _loaded_rows(spark, lake, loads)
    brought = [ledger.session_keys(feed, rows, "load_hour") for feed, rows in new.items()]
    keys = brought[0]
    for b in brought[1:]:
        keys = keys.unionByName(b)
    keys = cut(keys.distinct(), "touched-keys")
    old = _read(spark, f"{lake.raw}.replaced_keys").where(F.col("load").isin(loads)).select("feed", "event_id", "session_id")
    both = keys.select("feed", "event_id", "session_id").union(old)
    ids = cut(both.where(F.col("event_id").isNotNull()).select("event_id").distinct(), "touched-events")

    ids = _sent(ids)
    clicks = _read(spark, f"{lake.raw}.browser_events").select("event_id", F.col("click_id").alias("session_id"))
    clicks = cut(_of(clicks, ids, "event_id").distinct(), "touched-clicks")
    pages = _read(spark, f"{lake.raw}.location_events").select("event_id", "load_hour")
    pages = _of(pages, ids, "event_id").distinct()
    several = clicks.groupBy("event_id").agg(F.count("*").alias("n")).where("n > 1").select("event_id")
    _keep(clicks.join(several, "event_id"), f"{lake.state}.shared_events", run)
    hours = keys.where(F.col("feed") != "location_events").select("session_id", "feed", "load_hour").union(
        clicks.join(pages.hint("merge"), "event_id").select("session_id", F.lit("location_events"), "load_hour"))
    _keep(hours.distinct(), f"{lake.state}.session_hours", run)

    direct = both.where(F.col("feed") != "location_events").select("session_id").union(clicks.select("session_id")).distinct()
    shared = _read(spark, f"{lake.state}.shared_events").select("event_id", "session_id").distinct()
    changed = cut(_neighbours(cut(direct, "touched-sessions"), shared), "changed-sessions")
    return changed, cut(_neighbours(changed, shared), "input-sessions")


def _raw_rows(spark: SparkSession, lake: Lakehouse, sessions: DataFrame) -> dict[str, DataFrame]:
    """The raw rows of the sessions, from the delivery hours that hold any of them."""
    mine = _sent(sessions)
    where = cut(_of(_read(spark, f"{lake.state}.session_hours"), mine, "session_id").select("feed", "load_hour").distinct(), "session-hours")

    def pruned(feed: str) -> DataFrame:
        hours = _hours(where.where(F.col("feed") == feed), "load_hour")
        return _read(spark, f"{lake.raw}.{feed}").where(F.col("load_hour").isin(hours)).drop("load_hour", "delivery")

    by_session = [feed for feed in schemas.FEEDS if feed != "location_events"]
    out = dict(zip(by_session, _side_by_side(lambda feed: cut(_of(pruned(feed), mine, "click_id"), f"rows-{feed}"), by_session), strict=True))
    ids = cut(out["browser_events"].where(F.col("event_id").isNotNull()).select("event_id").distinct(), "row-events")
    out["location_events"] = cut(_of(pruned("location_events"), _sent(ids), "event_id"), "rows-location_events")
    return out


def _stage_rows(name: str, feeds: Mapping[str, DataFrame], tr: DataFrame) -> DataFrame:
    """A stage table of the feeds' rows and their transitions."""
    return {"transitions": lambda: tr, "purchases": lambda: stage.purchases_from_events(tr, shuffled=True),
            "conversion": lambda: stage.conversion_from_ids(tr.select("session_id", "event_id"), feeds["location_events"]),
            "devices": lambda: stage.devices(feeds["device_events"]), "events": lambda: stage.events(feeds["browser_events"]),
            "geo": lambda: stage.geo(feeds["geo_events"]), "session_info": lambda: stage.session_info(feeds["browser_events"])}[name]()


def mart_sums(s: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Of some sessions' stage rows: the keys of each mart with value and n, the number of rows behind it."""
    hour = hour_start("event_timestamp").alias("date_part")
    bought = s["purchases"].groupBy("session_id", hour).agg(F.sum("product_count").alias("value"), F.count("*").alias("n"))
    seen = s["transitions"].groupBy("session_id", event_label("page_url_path").alias("event"), hour, "browser_name").agg(F.count("*").alias("n"))
    visits = s["transitions"].where(is_product("page_url_path")).groupBy(product_name("page_url_path").alias("product")).agg(F.count("*").alias("n"))
    once = lambda df: df.distinct().withColumns({"value": F.lit(0).cast("long"), "n": F.lit(1).cast("long")})
    same = lambda df: df.withColumn("value", F.col("n"))
    c, d = (joined_by_session(s)[name] for name in ("conversion", "devices"))
    parts = {
        "campaign_purchase_analysis_hourly": bought.join(c.select("session_id", "utm_campaign", "utm_medium"), "session_id"),
        "click_conversion_rates_hourly": bought.join(c.select("session_id", "utm_source"), "session_id"),
        "events_distribution_hourly": same(seen.join(d.select("session_id", "os_name", "device_type"), "session_id")),
        "purchased_products_count_hourly": bought,
        "top_performing_products": same(visits),
        "users_segments_agg": once(d.select("session_id", "os_name", "device_type", "user_custom_id").join(
            c.select("session_id", "utm_source"), "session_id")),
        "users_purchases_segments_agg": bought.groupBy("session_id").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).join(
            d.select("session_id", "device_type", "os_name"), "session_id").join(c.select("session_id", "utm_source"), "session_id"),
    }
    return {mart: parts[mart].groupBy(*keys).agg(F.sum("value").alias("value"), F.sum("n").alias("n")) for mart, (keys, _) in MART_KEYS.items()}


def _compute(spark: SparkSession, lake: Lakehouse, run: int, loads: list[int], path: str) -> None:
    """Steps 1 to 4; what step 5 needs is stored below ``path``."""
    changed, inputs = _touched(spark, lake, run, loads)
    mine = _sent(changed)
    hours = _of(_read(spark, f"{lake.state}.session_hours"), mine, "session_id")
    known = _of(_read(spark, f"{lake.state}.homes").where(F.col("run") != run), mine, "session_id").select("session_id", "home")
    fresh = hours.groupBy("session_id").agg(F.min("load_hour").alias("home"))
    fresh = _of(fresh, known.select(F.col("session_id").alias("_key")).hint("merge"), "session_id", "left_anti")
    _keep(fresh, f"{lake.state}.homes", run)
    known.union(_read(spark, f"{lake.state}.homes").where(F.col("run") == run).select("session_id", "home")).write.parquet(f"{path}/sessions")
    sessions = spark.read.parquet(f"{path}/sessions")
    homes, at_home = _hours(sessions, "home"), _sent(sessions.select("session_id", "home"))
    mine = at_home.select("_key")

    feeds = {feed: rows.hint("merge") for feed, rows in _raw_rows(spark, lake, inputs).items()}
    tr = cut(stage.transitions(feeds["browser_events"], feeds["location_events"]), "transitions")

    def build(name: str) -> tuple[DataFrame, DataFrame]:
        """The sessions' new rows of a stage table, and their old ones."""
        rows = _of(_stage_rows(name, feeds, tr), at_home, "session_id", "inner")
        rows.write.parquet(f"{path}/{name}")
        old = _of(_read(spark, f"{lake.stage}.{name}").where(F.col("home").isin(homes)), mine, "session_id")
        in_marts = name in ("purchases", "transitions", "conversion", "devices")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}"), cut(old, f"old-{name}") if in_marts else old

    built = dict(zip(STAGE_TABLES, _side_by_side(build, STAGE_TABLES), strict=True))
    after, before = (mart_sums({name: pair[i] for name, pair in built.items()}) for i in (0, 1))

    def add(mart: str) -> None:
        keys = MART_KEYS[mart][0]
        less = before[mart].withColumns({"value": -F.col("value"), "n": -F.col("n")})
        delta = after[mart].unionByName(less).groupBy(*keys).agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
        _keep(delta.where("value <> 0 or n <> 0"), f"{lake.state}.{mart}_delta", run)

    _side_by_side(add, MART_TABLES)


def _swap(spark: SparkSession, lake: Lakehouse, path: str) -> None:
    """Step 5: the homes of the sessions, with the new rows of these and the old rows of all others."""
    sessions = spark.read.parquet(f"{path}/sessions")
    homes, mine = _hours(sessions, "home"), _sent(sessions.select("session_id"))

    def swap(name: str) -> None:
        table = f"{lake.stage}.{name}"
        stored = _read(spark, table)
        others = _of(stored.where(F.col("home").isin(homes)), mine, "session_id", "left_anti")
        new = spark.read.schema(stored.schema).parquet(f"{path}/{name}")
        empty = sorted(set(homes) - set(_hours(new, "home")))
        if empty:
            empty = sorted(set(empty) - set(_hours(others.where(F.col("home").isin(empty)), "home")))
        # few files a home, of any number of tasks; partitions are replaced once all rows are written
        others.unionByName(new).hint("rebalance", "home").write.mode("overwrite").insertInto(table)
        if empty:
            specs = ", ".join(f"PARTITION (home = TIMESTAMP_NTZ '{h:%Y-%m-%d %H:%M:%S}')" for h in empty)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")

    _side_by_side(swap, STAGE_TABLES)


def marts(spark: SparkSession, lake: Lakehouse) -> dict[str, DataFrame]:
    """The marts as sums of all deltas."""
    out = {}
    for mart, (keys, value) in MART_KEYS.items():
        rows = _read(spark, f"{lake.state}.{mart}_delta").groupBy(*keys).agg(F.sum("value").alias("value"), F.sum("n").alias("n")).where("n > 0")
        if mart == "users_segments_agg":
            out[mart] = rows.groupBy(*keys[:-1]).agg(F.count(keys[-1]).alias(value))
        else:
            out[mart] = rows.select(*keys, F.col("value").alias(value))
    return out


def propagate(spark: SparkSession, lake: Lakehouse = Lakehouse()) -> int | None:
    """Bring stage and marts up to the ledger. Returns the run's number, or None if there was nothing to do."""
    create(spark, lake)
    log = _read(spark, f"{lake.state}.runs").collect()  # a few rows a run
    steps = {(r["run"], r["step"]): r for r in log}
    open_ = [r for r in log if r["step"] == BEGAN and (r["run"], DONE) not in steps]
    if open_:
        run, loads = open_[0]["run"], open_[0]["loads"]
    else:
        taken = {x for r in log if r["step"] == BEGAN for x in r["loads"]}
        loads = sorted({r["load"] for r in ledger.history(spark, lake.raw).select("load").distinct().collect()} - taken)
        if not loads:
            return None
        run = loads[-1]
        _log(spark, lake, run, BEGAN, loads, None)
    computed = steps.get((run, COMPUTED))
    path = computed["path"] if computed else scratch_path(spark, "incremental", f"{run}-{uuid.uuid4().hex}")
    if not computed:
        _compute(spark, lake, run, loads, path)
        _log(spark, lake, run, COMPUTED, loads, path)
        release(spark)
    _swap(spark, lake, path)
    save_together({f"{lake.mart}.{mart}": df for mart, df in marts(spark, lake).items()}, AT_ONCE)
    _log(spark, lake, run, DONE, loads, None)
    discard(spark, path)
    release(spark)
    return run


def run_hour(spark: SparkSession, root: str, hour, layout: str = "landing", lake: Lakehouse = Lakehouse()) -> DataFrame:
    """Load one hour of the four feeds (missing feeds are skipped) and bring stage and marts up to it. Returns the load report."""
    report = ingest.ingest_hours(spark, root, [hour], layout, lake.raw)
    propagate(spark, lake)
    return report


def backfill(spark: SparkSession, root: str, start, end, layout: str = "landing", lake: Lakehouse = Lakehouse()) -> DataFrame:
    """Load what the ledger lacks from ``start`` to ``end`` and bring stage and marts up to it. Returns the state of every feed-hour."""
    found = ingest.ingest_pending(spark, root, start, end, layout, lake.raw)
    propagate(spark, lake)
    return found


def long_form(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All marts as rows of mart, key (its keys, joined by bars) and value."""
    out = None
    for mart in MART_TABLES:
        keys, value = MART_KEYS[mart]
        keys = keys[:-1] if mart == "users_segments_agg" else keys
        text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys))
        part = tables[mart].select(F.lit(mart).alias("mart"), text.alias("key"), F.col(value).cast("long").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
