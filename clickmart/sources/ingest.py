"""Batch ingest of the JSON-lines feeds into the raw layer.

Layouts (one file per feed and hour):

* landing: ``{root}/data/{feed}/{year}-{month}-{day}-H{hour}.jsonl``
  (month unpadded, day and hour two digits);
* source: ``{root}/year={year}/month={month}/day={day}/hour={hour}/{feed}.jsonl[.zip]``.

Files are read with the feed's explicit schema (by name: key order does not
matter, unknown keys are ignored, malformed lines land in ``_corrupt_record``),
ids are normalised to lower-case UUID text and every row carries the
``load_hour`` it was delivered for. Raw tables are partitioned by
``(load_hour, delivery)``, a delivery being one file: loading a file again
replaces what it brought before, and two files of one hour stand side by side.
Lines that cannot be read, and files whose name holds no hour, go to
``{feed}_rejected`` with the reason.

The input of a load is parsed once: its rows are stored below the scratch folder,
tables and report are filled from there, and the folder goes. What was loaded,
and when, stands in the ledger (``sources.ledger``).
"""

from __future__ import annotations

import datetime as dt
import io
import re
import time
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import normalise_uuid
from clickmart.session import discard, scratch_path
from clickmart.sources import ledger, schemas
from clickmart.sources.files import KNOWN_SCHEMES, open_input, scheme

LOAD_HOUR = "load_hour"
DELIVERY = "delivery"
# 2024-01-01 05:00:00, 2024-01-01T05:00:00Z; 0 to 6 digits of a second
TIMESTAMPS = "yyyy-MM-dd['T'][' ']HH:mm:ss[.SSSSSS]['Z']"


# ---- hour addressing (I4) ----------------------------------------------------
def hour_parts(hour: dt.datetime) -> dict[str, str]:
    return {"year": str(hour.year), "month": str(hour.month),
            "day": f"{hour.day:02d}", "hour": f"{hour.hour:02d}"}


def landing_path(root: str, feed: str, hour: dt.datetime) -> str:
    p = hour_parts(hour)
    return f"{root.rstrip('/')}/data/{feed}/{p['year']}-{p['month']}-{p['day']}-H{p['hour']}.jsonl"


def source_path(root: str, feed: str, hour: dt.datetime, zipped: bool = True) -> str:
    p = hour_parts(hour)
    ext = ".jsonl.zip" if zipped else ".jsonl"
    return (f"{root.rstrip('/')}/year={p['year']}/month={p['month']}/day={p['day']}/"
            f"hour={p['hour']}/{feed}{ext}")


def hours_between(start: dt.datetime, end: dt.datetime) -> list[dt.datetime]:
    """Whole hours from ``start`` to ``end`` inclusive."""
    h = start.replace(minute=0, second=0, microsecond=0)
    out = []
    while h <= end:
        out.append(h)
        h += dt.timedelta(hours=1)
    return out


# Hour of a landing file from its name: 2024-1-08-H05.jsonl
_LANDING_RE = r"(\d{4})-(\d{1,2})-(\d{1,2})-H(\d{1,2})\.jsonl"


def _hour_from_landing_name(name_col) -> F.Column:
    g = [F.regexp_extract(name_col, _LANDING_RE, i).try_cast("int") for i in (1, 2, 3, 4)]
    return F.make_timestamp_ntz(g[0], g[1], g[2], g[3], F.lit(0), F.lit(0))


# ---- path existence (I5) ---------------------------------------------------
def files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """Path, size and time of change (ms) of every file that matches the pattern, by one call to the file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found or ()]


def listing(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Path and size of every file that matches the pattern."""
    return {path: size for path, size, _ in files(spark, pattern)}


def _tail(path: str, parts: int) -> str:
    return "/".join(path.split("/")[-parts:])


def existing(spark: SparkSession, paths: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split paths into (present, missing): a missing hour is skipped, not an error.

    The paths' hive or landing layout is listed once for all hours.
    """
    paths = list(paths)
    patterns = {re.sub(r"=\d+(?=/)", "=*", re.sub(r"[^/]*-H\d\d\.jsonl$", "*.jsonl", p)): p.count("/") for p in paths}
    there = {(n, _tail(f, 5)) for pattern, n in patterns.items() for f in listing(spark, pattern)}
    present = [p for p in paths if "*" in p and listing(spark, p) or (p.count("/"), _tail(p, 5)) in there]
    kept = set(present)
    return present, [p for p in paths if p not in kept]


# ---- writing landing-style JSON lines (tests, replays) ----------------------
JSON_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_json_feed(df: DataFrame, path: str) -> None:
    """Write a feed as JSON-lines part files (timestamps in the feed's text form)."""
    (df.write.mode("overwrite").option("timestampNTZFormat", JSON_TS_FORMAT)
     .option("ignoreNullFields", "true").json(path))


# ---- reading (I1, I2) --------------------------------------------------------
def _normalise(df: DataFrame, feed: str) -> DataFrame:
    ids = schemas.ID_COLUMNS[feed]
    return df.select([normalise_uuid(c).alias(c) if c in ids else F.col(c) for c in df.columns])


def _readable(feed: str) -> F.Column:
    """Not NULL, and made from all columns: a scan that is asked for some of
    them does not look at the others, and would miss a bad field there."""
    return F.to_json(F.struct(*[f.name for f in schemas.FEED_SCHEMAS[feed].fields]))


def read_json_feed(spark: SparkSession, paths: str | Sequence[str], feed: str,
                   keep_corrupt: bool = True) -> DataFrame:
    """JSON-lines file(s) or glob(s) of one feed, explicit schema, by name.
    Adds ``load_hour`` from landing file names when they follow the layout."""
    schema = schemas.with_corrupt_column(schemas.FEED_SCHEMAS[feed])
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN)
          .option("timestampNTZFormat", TIMESTAMPS)
          .json(paths))
    df = df.withColumns({LOAD_HOUR: _hour_from_landing_name(F.col("_metadata.file_name")),
                         DELIVERY: F.col("_metadata.file_name")})
    df = _normalise(df, feed)
    return df if keep_corrupt else df.where(
        F.col(schemas.CORRUPT_COLUMN).isNull() & _readable(feed).isNotNull()).drop(schemas.CORRUPT_COLUMN)


def feed_counts(spark: SparkSession, root: str) -> DataFrame:
    """I2 / E2 over files: readable rows per feed across all landing files of each feed."""
    parts = []
    for feed in schemas.FEEDS:
        glob = f"{root.rstrip('/')}/data/{feed}/*.jsonl"
        if not existing(spark, [glob])[0]:
            continue
        df = read_json_feed(spark, glob, feed, keep_corrupt=False)
        parts.append(df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(feed).alias("source"), "cnt"))
    out = spark.createDataFrame([], "source string, cnt long")
    for p in parts:
        out = out.unionByName(p)
    return out


# ---- zipped source files (I3) -----------------------------------------------
CHUNK_BYTES = 4 << 20  # lines handed on at a time


def _chunks(path: str, archive) -> Iterator[pa.RecordBatch]:
    """The lines of the archive's first member, inflated as they are read, in batches of bounded bytes."""
    with zipfile.ZipFile(archive) as zf:
        names = zf.namelist()
        if not names:
            return
        with zf.open(names[0]) as member:
            lines: list[str] = []
            size = 0
            for line in member:
                line = line.rstrip(b"\r\n")
                if line.strip():
                    lines.append(line.decode("utf-8", "replace"))
                    size += len(line)
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "value": lines})
                    lines, size = [], 0
            if lines:
                yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "value": lines})


def _unzip_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per archive: the directory at its end and the first member are read from a file handle."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_input(path) as archive:
                yield from _chunks(path, archive)


def _unzip_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_unzip_files``, of whole archives, for stores that only Spark reads."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            yield from _chunks(path, io.BytesIO(content.as_py()))


def read_zipped_feed(spark: SparkSession, paths: str | Sequence[str], feed: str) -> DataFrame:
    """Zipped JSON-lines (first archive member) as a feed DataFrame.

    Spark has no zip codec, so a task opens each of its archives as a file,
    reads the directory at its end and inflates the first member as a stream,
    in memory that does not grow with the archive; the lines are then parsed by
    ``from_json`` on the JVM with the feed schema. Archives (any size) are
    spread over tasks like other files, one task each, since deflated data
    cannot be entered in the middle; the hour comes from the hive-style path.
    In a store that only Spark reads, an archive is one ``binaryFile`` row, of
    2 GB at most.
    """
    schema = schemas.with_corrupt_column(schemas.FEED_SCHEMAS[feed])
    paths = [paths] if isinstance(paths, str) else list(paths)
    bins = spark.read.format("binaryFile").load(paths)
    if all(scheme(p) in KNOWN_SCHEMES for p in paths):
        lines = bins.select("path").mapInArrow(_unzip_files, "path string, value string")
    else:
        lines = bins.select("path", "content").mapInArrow(_unzip_contents, "path string, value string")
    parsed = lines.select(
        "path",
        F.from_json("value", schema, {"mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN,
                                      "timestampNTZFormat": TIMESTAMPS}).alias("r"))
    df = parsed.select("r.*", _hour_from_source_path(F.col("path")).alias(LOAD_HOUR),
                       F.element_at(F.split("path", "/"), -1).alias(DELIVERY))
    return _normalise(df, feed)


_SOURCE_RE = r"year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})/hour=(\d{1,2})/"


def _hour_from_source_path(path_col) -> F.Column:
    g = [F.regexp_extract(path_col, _SOURCE_RE, i).try_cast("int") for i in (1, 2, 3, 4)]
    return F.make_timestamp_ntz(g[0], g[1], g[2], g[3], F.lit(0), F.lit(0))


# ---- load report (I6) and raw tables (I7, I9, I10) ---------------------------
REPORT_SCHEMA = ("feed string, load_hour timestamp_ntz, status string, path string, size long, "
                 "rows long, corrupt_rows long, parsed_rows long")


def load_counts(df: DataFrame, feed: str) -> DataFrame:
    """Rows, malformed rows and rows with a parsed first column per delivery of one feed."""
    first = schemas.FEED_SCHEMAS[feed].fields[0].name
    return (df.groupBy(LOAD_HOUR, DELIVERY)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count(schemas.CORRUPT_COLUMN).alias("corrupt_rows"),
                 F.count(F.when(_readable(feed).isNotNull(), F.col(first))).alias("parsed_rows")))


def load_report(df: DataFrame, feed: str) -> DataFrame:
    """``load_counts`` as report rows."""
    return load_counts(df, feed).select(
        F.lit(feed).alias("feed"), LOAD_HOUR, F.lit("loaded").alias("status"), F.col(DELIVERY).alias("path"),
        F.lit(None).cast("long").alias("size"), "rows", "corrupt_rows", "parsed_rows")


def skipped_report(spark: SparkSession, feed: str, missing: Sequence[tuple[dt.datetime, str]]) -> DataFrame:
    return spark.createDataFrame([(feed, h, "skipped", p, None, 0, 0, 0) for h, p in missing], REPORT_SCHEMA)


def create_layers(spark: SparkSession, databases: Sequence[str] = ("raw", "stage", "mart")) -> None:
    """CREATE DATABASE IF NOT EXISTS for each layer."""
    for db in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


# Of a partitioned table: an overwrite replaces the partitions it has rows of, whatever the session's
# spark.sql.sources.partitionOverwriteMode (insertInto does not pass a writer's options on).
REPLACEABLE = "USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"


def create_raw_tables(spark: SparkSession, db: str = "raw") -> None:
    """The four raw tables and their rejects, partitioned by hour and delivery."""
    create_layers(spark, [db])
    by = f"{LOAD_HOUR} TIMESTAMP_NTZ, {DELIVERY} STRING) {REPLACEABLE} PARTITIONED BY ({LOAD_HOUR}, {DELIVERY})"
    for feed, schema in schemas.FEED_SCHEMAS.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{feed} ({schemas.ddl(schema)}, {by}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{feed}_rejected (line STRING, reason STRING, {by}")
    ledger.create(spark, db)


def _replace(df: DataFrame, table: str) -> None:
    """Insert by name, replacing the partitions that ``df`` has rows of (the table is ``REPLACEABLE``)."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.mode("overwrite").insertInto(table)


def write_raw(df: DataFrame, feed: str, db: str = "raw", load: int | None = None) -> list[Row]:
    """Insert parsed rows into ``raw.{feed}`` by name, replacing only their
    own deliveries (a retry does not duplicate, another file of the hour stays).
    Lines that cannot be read and rows of files without an hour in their name
    go to ``raw.{feed}_rejected``. ``df`` is evaluated once, into scratch rows that
    both tables and the returned counts per delivery are taken from. ``load``: the
    ledger keeps the keys of what is replaced under this number."""
    spark = df.sparkSession
    names = [f.name for f in schemas.FEED_SCHEMAS[feed].fields]
    path = scratch_path(spark, "deliveries", f"{feed}-{uuid.uuid4().hex}")
    rows = df.select(*names, schemas.CORRUPT_COLUMN, LOAD_HOUR, DELIVERY)
    rows.write.parquet(path)
    try:
        rows = spark.read.schema(rows.schema).parquet(path)
        counts = load_counts(rows, feed).collect()
        if load is not None:
            ledger.keep_replaced(spark, db, load, {feed: [(r[LOAD_HOUR], r[DELIVERY]) for r in counts if r[LOAD_HOUR] is not None]})
        bad, nowhere = F.col(schemas.CORRUPT_COLUMN), F.col(LOAD_HOUR).isNull()
        _replace(rows.where(bad.isNull() & ~nowhere).select(*names, LOAD_HOUR, DELIVERY), f"{db}.{feed}")
        if any(r["corrupt_rows"] or r[LOAD_HOUR] is None for r in counts):
            line = F.coalesce(bad, F.to_json(F.struct(*names)))
            reason = F.when(bad.isNotNull(), "unreadable line").otherwise("no hour in the file name")
            _replace(rows.where(bad.isNotNull() | nowhere).select(line.alias("line"), reason.alias("reason"), LOAD_HOUR, DELIVERY),
                     f"{db}.{feed}_rejected")
    finally:
        discard(spark, path)
    return counts


def _partition(spec: str) -> tuple[str, str]:
    """(hour, delivery) of a line of SHOW PARTITIONS."""
    return tuple(unquote(part.split("=", 1)[1]) for part in spec.split("/", 1))


def drop_deliveries(spark: SparkSession, table: str, deliveries: Iterable[tuple[dt.datetime, str]]) -> int:
    """Remove what earlier loads of these deliveries brought; returns how many there were. The partitions
    are listed once, and those that exist go in one statement."""
    wanted = {(f"{hour:%Y-%m-%d %H:%M:%S}", name) for hour, name in deliveries}
    there = sorted(wanted & {_partition(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}) if wanted else []
    if there:
        quoted = [(h, name.replace("\\", "\\\\").replace("'", "\\'")) for h, name in there]
        specs = ", ".join(f"PARTITION ({LOAD_HOUR} = TIMESTAMP_NTZ '{h}', {DELIVERY} = '{name}')" for h, name in quoted)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return len(there)


def read_raw(spark: SparkSession, db: str = "raw") -> dict[str, DataFrame]:
    """The raw feeds as stored (I12 for the raw layer)."""
    return {feed: spark.table(f"{db}.{feed}").drop(LOAD_HOUR, DELIVERY) for feed in schemas.FEEDS}


def catalog_listing(spark: SparkSession) -> DataFrame:
    """(database, table) of every table in the session catalog."""
    rows = [(db.name, t.name) for db in spark.catalog.listDatabases()
            for t in spark.catalog.listTables(db.name) if not t.isTemporary]
    return spark.createDataFrame(rows, "database string, table string")


def _patterns(root: str, feed: str, layout: str) -> str:
    """What all deliveries of a feed match."""
    root = root.rstrip("/")
    return f"{root}/data/{feed}/*.jsonl" if layout == "landing" else f"{root}/year=*/month=*/day=*/hour=*/{feed}.jsonl{'.zip' * (layout == 'zip')}"


def _path(root: str, feed: str, hour: dt.datetime, layout: str) -> str:
    return landing_path(root, feed, hour) if layout == "landing" else source_path(root, feed, hour, zipped=layout == "zip")


def _ingest_feed(spark: SparkSession, root: str, feed: str, hours: Sequence[dt.datetime], layout: str, db: str) -> list[tuple]:
    """Load one feed; ledger rows without the load's number."""
    wanted = {_path(root, feed, h, layout): h for h in hours}
    found = {_tail(p, 5): (size, changed) for p, size, changed in files(spark, _patterns(root, feed, layout))} if wanted else {}
    present = {p: h for p, h in wanted.items() if _tail(p, 5) in found}
    out = [(feed, h, _tail(p, 1), p, None, None, ledger.SKIPPED, 0, 0, 0) for p, h in wanted.items() if p not in present]
    if present:
        df = (read_zipped_feed(spark, list(present), feed) if layout == "zip"
              else read_json_feed(spark, list(present), feed))
        if layout == "source":
            df = df.withColumn(LOAD_HOUR, _hour_from_source_path(F.col("_metadata.file_path")))
        counts = {(r[LOAD_HOUR], r[DELIVERY]): r for r in write_raw(df, feed, db)}
        for table, field in ((feed, lambda r: r["rows"] - r["corrupt_rows"]), (f"{feed}_rejected", lambda r: r["corrupt_rows"])):
            drop_deliveries(spark, f"{db}.{table}", [
                (h, _tail(p, 1)) for p, h in present.items()
                if (h, _tail(p, 1)) not in counts or not field(counts[h, _tail(p, 1)])])
        for p, h in present.items():
            r = counts.get((h, _tail(p, 1)))
            out.append((feed, h, _tail(p, 1), p, *found[_tail(p, 5)], ledger.LOADED,
                        *((r["rows"], r["corrupt_rows"], r["parsed_rows"]) if r else (0, 0, 0))))
    return out


def load(spark: SparkSession, root: str, wanted: dict[str, Sequence[dt.datetime]], layout: str = "landing", db: str = "raw",
         consume: bool = False) -> DataFrame:
    """Load the wanted hours of each feed into the raw tables, one job per feed
    and the feeds side by side, and write the ledger. An hour delivered again
    replaces what it brought before, even if it is empty now; the keys of what
    it replaces are kept in the ledger first. Returns the load report."""
    create_raw_tables(spark, db)
    number = time.time_ns()
    ledger.keep_replaced(spark, db, number, {feed: [(h, _tail(_path(root, feed, h, layout), 1)) for h in hours] for feed, hours in wanted.items()})
    with ThreadPoolExecutor(len(schemas.FEEDS)) as pool:
        parts = list(pool.map(lambda feed: _ingest_feed(spark, root, feed, wanted.get(feed, ()), layout, db), schemas.FEEDS))
    rows = [r for part in parts for r in part]
    ledger.record(spark, db, number, rows)
    if consume:
        for path in [r[3] for r in rows if r[6] == ledger.LOADED]:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    return spark.createDataFrame([(f, h, status, path, size, *counts) for f, h, _, path, size, _, status, *counts in rows], REPORT_SCHEMA)


def ingest_hours(spark: SparkSession, root: str, hours: Sequence[dt.datetime], layout: str = "landing",
                 db: str = "raw", consume: bool = False) -> DataFrame:
    """Load the given hours of all four feeds into the raw tables, one job per
    feed (not one per hour) and the feeds side by side; missing feed-hours are
    skipped and reported. An hour delivered again replaces what it brought
    before, even if it is empty now. ``consume`` removes the loaded files.
    Returns the load report (feed, load_hour, status, path, size, rows,
    corrupt_rows, parsed_rows), one row per feed and hour."""
    return load(spark, root, {feed: hours for feed in schemas.FEEDS}, layout, db, consume)


def deliveries(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime, layout: str = "landing") -> DataFrame:
    """Feed, load_hour, path, size and modified (both null if missing) of every feed-hour from ``start`` to ``end``."""
    found = [(feed, _tail(p, 5), size, changed) for feed in schemas.FEEDS for p, size, changed in files(spark, _patterns(root, feed, layout))]
    there = spark.createDataFrame(found, "feed string, tail string, size long, modified long")
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    span = F.sequence(*(F.lit(f"{h.replace(minute=0, second=0, microsecond=0):%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") for h in (start, end)), F.expr("interval 1 hour"))
    hours = spark.range(1).select(F.explode(span).alias(LOAD_HOUR)).select(F.explode(F.array(*map(F.lit, schemas.FEEDS))).alias("feed"), LOAD_HOUR)
    y, m, d, h = F.year(LOAD_HOUR).cast("string"), F.month(LOAD_HOUR).cast("string"), pad(F.day(LOAD_HOUR)), pad(F.hour(LOAD_HOUR))
    name = (F.concat(F.lit("data/"), "feed", F.lit("/"), y, F.lit("-"), m, F.lit("-"), d, F.lit("-H"), h, F.lit(".jsonl")) if layout == "landing" else
            F.concat(F.lit("year="), y, F.lit("/month="), m, F.lit("/day="), d, F.lit("/hour="), h, F.lit("/"), "feed", F.lit(".jsonl" + ".zip" * (layout == "zip"))))
    path = F.concat(F.lit(root.rstrip("/") + "/"), name)
    return hours.withColumns({"path": path, "tail": F.substring_index(path, "/", -5)}).join(there, ["feed", "tail"], "left").select(
        "feed", LOAD_HOUR, "path", "size", "modified")


def ingest_pending(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime, layout: str = "landing", db: str = "raw") -> DataFrame:
    """Load what the ledger lacks of the feed-hours from ``start`` to ``end``: files that are new, or that changed
    since they were loaded. Returns every feed-hour with its state: new, changed, kept or missing."""
    create_raw_tables(spark, db)
    plan = ledger.compare(deliveries(spark, root, start, end, layout), ledger.current(spark, db))
    rows = plan.collect()  # one a feed-hour
    wanted: dict[str, list[dt.datetime]] = {}
    for r in rows:
        if r["state"] in (ledger.NEW, ledger.CHANGED):
            wanted.setdefault(r["feed"], []).append(r[LOAD_HOUR])
    if wanted:
        load(spark, root, wanted, layout, db)
    return spark.createDataFrame(rows, plan.schema)
