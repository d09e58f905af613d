"""Deliveries written as the feeds' producers do: one JSON-lines file per feed and hour (replays, queries, tests).

The lines of a file go to one task, which writes them as they come; a file
appears under its name once it is complete.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.sources import schemas
from clickmart.sources.feeds import feed_from_events
from clickmart.sources.files import filesystem
from clickmart.sources.ingest import JSON_TS_FORMAT


class _File:
    """A file that is moved to its name when it is closed; zipped if its name says so."""

    def __init__(self, path: str):
        self.system, self.name = filesystem(path)
        folder, _, base = self.name.rpartition("/")
        self.part = f"{folder}/_{base}.part"
        self.system.create_dir(folder, recursive=True)
        self.raw = self.out = self.system.open_output_stream(self.part)
        self.zip = None
        if base.endswith(".zip"):
            self.zip = zipfile.ZipFile(self.raw, "w", zipfile.ZIP_DEFLATED)
            self.out = self.zip.open(base.removesuffix(".zip"), "w", force_zip64=True)

    def close(self) -> None:
        if self.zip:
            self.out.close()
            self.zip.close()
        self.raw.close()
        self.system.move(self.part, self.name)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, file, n = None, None, 0

    def done() -> pa.RecordBatch:
        file.close()
        return pa.RecordBatch.from_pydict({"path": [path], "lines": [n]})

    for batch in batches:
        for to, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if to != path:
                if file:
                    yield done()
                path, file, n = to, _File(to), 0
            file.out.write(value.encode() + b"\n")
            n += 1
    if file:
        yield done()


def _path(root: str, feed: str, hour: Column, layout: str) -> Column:
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    y, m, d, h = F.year(hour).cast("string"), F.month(hour).cast("string"), pad(F.day(hour)), pad(F.hour(hour))
    root = root.rstrip("/")
    if layout == "landing":
        return F.concat(F.lit(f"{root}/data/{feed}/"), y, F.lit("-"), m, F.lit("-"), d, F.lit("-H"), h, F.lit(".jsonl"))
    ext = ".jsonl.zip" if layout == "zip" else ".jsonl"
    return F.concat(F.lit(f"{root}/year="), y, F.lit("/month="), m, F.lit("/day="), d, F.lit("/hour="), h, F.lit(f"/{feed}{ext}"))


def deliver(events: DataFrame, root: str, layout: str = "landing", grain: str = "day", feeds=schemas.FEEDS, broken: Column | None = None,
            hours_late: int = 0) -> int:
    """Write the feeds of ``events`` as one file per feed and ``grain`` (named by its first hour); returns the number of files.

    ``broken``: a condition on events whose location lines lose their last character; ``hours_late`` moves the files' hour.
    """
    hour = F.date_trunc(grain, "ts").cast("timestamp_ntz") + F.expr(f"INTERVAL {hours_late} HOURS")
    src = events.withColumns({"_hour": hour.cast("timestamp_ntz"), "_broken": broken if broken is not None else F.lit(False)})
    parts = []
    for feed in feeds:
        names = [f.name for f in schemas.FEED_SCHEMAS[feed].fields]
        value = F.to_json(F.struct(*names), {"timestampNTZFormat": JSON_TS_FORMAT})
        if feed == "location_events":
            value = F.when(F.col("_broken"), F.expr("substring(line, 1, length(line) - 1)")).otherwise(F.col("line"))
            rows = feed_from_events(src, feed, keep=("_hour", "_broken")).withColumn("line", F.to_json(F.struct(*names)))
        else:
            rows = feed_from_events(src, feed, keep=("_hour",))
        parts.append(rows.select(_path(root, feed, F.col("_hour"), layout).alias("path"), value.alias("value")))
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    written = lines.repartition("path").sortWithinPartitions("path").mapInArrow(_write, "path string, lines long")
    return written.agg(F.count("*")).first()[0]
