"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark passages, tokens.

Each stage works on all documents its predecessor kept. All but the last
return the columns of ``documents``; the last returns the token ids.

Defined results of every stage: a null or empty text is kept (it is not toxic,
near to nothing, without passages and clean) and has null ids or none; a null
doc_id is kept and is near to nothing; of rows that repeat a document the
first stages keep all with the smallest doc_id, and the third takes the words
of copies that are left; very long texts are handled whole, alone in their
task; empty tables give empty results; further columns, whatever their names,
are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import decontaminate, minhash, sentencepieces, substring_dedup, toxicity
from clickmart.llm.common import stored, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go; without labelled rows of both classes nothing
    is learned (all of one class: all of it)."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of least doc_id stays."""
    return minhash.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word runs that occur more than once are cut out; every document stays."""
    return substring_dedup.remove_repeats(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a twentieth or more of benchmark passages make up go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces and ids of every document that is left."""
    return sentencepieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", remove_contaminated),
    ("sentencepiece", tokenize),
]

# Tokens cannot be expressed in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
