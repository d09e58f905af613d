"""Incremental ingest of landing files (I8).

A file-source stream over ``{root}/data/{feed}/`` with the feed schema,
triggered with ``availableNow``: every run picks up exactly the files that
arrived since the last run (tracked in the checkpoint), writes them to the
raw table through ``foreachBatch`` (dynamic overwrite of the delivered files,
so a replayed batch after a failure replaces rather than duplicates, and other
files of the same hour stay), then stops. Each batch is written to the ledger
of deliveries once it is in the table. Unreadable lines and files without
an hour in their name are kept in ``{feed}_rejected``. ``clean_source="delete"`` removes consumed files like the hourly
loader did; ``"archive"`` moves them to ``archive_dir``.

No stateful operator is involved: the hourly grain needs no watermark, and
stage/marts are rebuilt in batch afterwards.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.session import scratch_path
from clickmart.sources import ingest, ledger, schemas


def landing_stream(spark: SparkSession, root: str, feed: str, clean_source: str = "off",
                   archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    schema = schemas.with_corrupt_column(schemas.FEED_SCHEMAS[feed])
    reader = (spark.readStream.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN)
              .option("timestampNTZFormat", ingest.TIMESTAMPS)
              .option("pathGlobFilter", "*.jsonl")
              .option("cleanSource", clean_source))
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.json(f"{root.rstrip('/')}/data/{feed}/")
    name = F.col("_metadata.file_name")
    df = df.withColumns({ingest.LOAD_HOUR: ingest._hour_from_landing_name(name), ingest.DELIVERY: name})
    return ingest._normalise(df, feed)


def ingest_available(spark: SparkSession, root: str, feeds=schemas.FEEDS, db: str = "raw",
                     checkpoint_root: str | None = None, clean_source: str = "off",
                     archive_dir: str | None = None, max_files_per_trigger: int | None = None,
                     after_batch: Callable[[str, int], None] | None = None) -> dict[str, int]:
    """Load all newly arrived landing files of each feed; returns the number of
    micro-batches each stream ran. ``after_batch(feed, batch)`` is called when a
    batch is in the raw table and not yet in the checkpoint: if it raises, the
    stream ends there, and the next call runs that batch again."""
    ingest.create_raw_tables(spark, db)
    batches: dict[str, int] = {}
    for feed in feeds:
        ckpt = (checkpoint_root.rstrip("/") + f"/{feed}") if checkpoint_root else \
            scratch_path(spark, "streams", db, feed)

        def write_batch(batch: DataFrame, epoch_id: int, feed=feed) -> None:
            load = time.time_ns()
            counts = ingest.write_raw(batch, feed, db, load)
            ledger.record(batch.sparkSession, db, load, [
                (feed, r[ingest.LOAD_HOUR], r[ingest.DELIVERY], f"{root.rstrip('/')}/data/{feed}/{r[ingest.DELIVERY]}", None, None,
                 ledger.LOADED, r["rows"], r["corrupt_rows"], r["parsed_rows"]) for r in counts if r[ingest.LOAD_HOUR] is not None])
            if after_batch:
                after_batch(feed, epoch_id)

        q = (landing_stream(spark, root, feed, clean_source, archive_dir, max_files_per_trigger)
             .writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", ckpt)
             .trigger(availableNow=True)
             .start())
        try:
            q.awaitTermination()
        finally:
            for table in (feed, f"{feed}_rejected"):  # the batches wrote through a session of their own
                spark.catalog.refreshTable(f"{db}.{table}")
        batches[feed] = len(q.recentProgress)
    return batches
