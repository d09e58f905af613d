"""Spark session settings used by tests, the bench and the pipeline."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Session time zone is pinned so that anything
# rendered through TIMESTAMP (LTZ) is stable; the operators themselves only use
# time-zone free TIMESTAMP_NTZ arithmetic.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "clickmart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; where that is
    unset, a folder beside the tables, in the warehouse every executor reaches."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``checkpoint()`` at the shared folder unless the application has done so."""
    root = checkpoint_root(spark)
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of scratch rows that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of what earlier queries sent and shuffled: Spark removes it once the driver has collected its garbage, and a
    driver of many small queries enlarges its heap instead."""
    spark.sparkContext._jvm.System.gc()


SCRATCH = ("cut", "llm", "deliveries", "incremental", "landing", "ingest-json", "ingest-raw")


def sweep(spark: SparkSession, older_than_hours: float, kinds: Sequence[str] = SCRATCH) -> int:
    """Remove what queries left in these folders of the scratch folder before so many hours; returns how many there were.

    Stored steps belong to the query that wrote them, which may still be read:
    ``older_than_hours`` must exceed the longest a result is used.
    """
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    removed, before = 0, (time.time() - older_than_hours * 3600) * 1000
    for kind in kinds:
        top = fs.Path(scratch_path(spark, kind))
        system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in (system.listStatus(top) if system.exists(top) else ()):
            if found.getModificationTime() < before:
                removed += system.delete(found.getPath(), True)
    return removed


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: what follows is
    planned from the stored rows, which outlive any executor."""
    path = scratch_path(df.sparkSession, "cut", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
