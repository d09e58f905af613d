"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from clickmart.llm import (
    chat_format,
    decontaminate,
    language_id,
    minhash,
    oracle,
    periodic_runs,
    quality_rules,
    sentencepieces,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    toxicity,
    url_filter,
    warc,
)
from clickmart.llm.common import table
from clickmart.session import scratch_path


def op1_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    import uuid

    path = scratch_path(spark, "llm", f"warc-{uuid.uuid4().hex}")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_recompression(spark, sf_dir):
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op4_chat_format(spark, sf_dir):
    return chat_format.chat_format(table(spark, sf_dir, "conversations"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark, sf_dir):
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op9_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Similarity(shingle_words=4))


def op10_sentencepieces(spark, sf_dir):
    return sentencepieces.report(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark, sf_dir):
    return token_alignment.report(table(spark, sf_dir, "documents"))


def op12_language_id(spark, sf_dir):
    return language_id.report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


REGISTRY = {f.__name__: f for f in (
    op1_quality_rules, op2_warc, op3_recompression, op4_chat_format, op5_decontaminate, op6_toxicity, op7_url_filter, op8_suffix_dedup, op9_minhash, op10_sentencepieces,
    op11_token_alignment, op12_language_id, op13_periodic_runs)}

ORACLE_SQL = {
    "op1_quality_rules": oracle.OP1,
    "op2_warc": oracle.OP2,
    "op3_recompression": oracle.OP3,
    "op4_chat_format": oracle.OP4,
    "op5_decontaminate": oracle.OP5,
    "op7_url_filter": oracle.OP7,
    "op8_suffix_dedup": oracle.OP8,
    "op9_minhash": oracle.OP9,
}
