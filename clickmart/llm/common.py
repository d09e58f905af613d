"""Helpers shared by the training-data operators."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.session import scratch_path

# Text handled at a time inside a task; one longer text is handled alone.
SLICE_BYTES = 2 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SWITCH = threading.Lock()
_WRITING: dict[int, list] = {}  # by session: writes that are open, the setting before the first


@contextmanager
def without_shuffle_files(spark: SparkSession):
    """The shuffle files of a job that is run inside go as soon as it ends. Writes of several threads share the switch."""
    with _SWITCH:
        state = _WRITING.setdefault(id(spark), [0, spark.conf.get(CLEANUP, "false")])
        state[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _SWITCH:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(CLEANUP, _WRITING.pop(id(spark))[1])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs at most the tasks of the running
    job, and a result that is used twice is computed once. The job's shuffle
    files go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    with without_shuffle_files(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def told_apart(docs: DataFrame, name: Column, other: Column) -> Column:
    """``name``, but where rows of different ``other`` share it, a name of both."""
    sides = docs.select(name.alias("name"), other.alias("other")).groupBy("name").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    shared = [r["name"] for r in sides.where("low <> high").select("name").collect()]
    return F.when(name.isin(shared), F.xxhash64(name, other)).otherwise(name) if shared else name


def text_name(docs: DataFrame) -> Column:
    """A 64-bit name of ``text`` that differs between all different texts of ``docs``.

    It is xxhash64; texts that share it, but not a second such hash (128 bits in
    all), are named by both. Two texts in 2e9 share it by chance, so few names
    are collected.
    """
    return told_apart(docs, F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text")))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batches, text: str = "text", size: int = SLICE_BYTES):
    """Record batches cut so that each holds at most ``size`` bytes of text (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
