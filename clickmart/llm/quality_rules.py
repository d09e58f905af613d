"""Host-level quality rules (operator 1), DataFrame functions only.

Each document gets counts and a base verdict; failures are counted per host
with a partial aggregate; every host's failure rate is shrunk towards the
corpus rate with a beta prior fitted to the hosts themselves; the verdict of
the host is joined back. A host with a third of all documents costs nothing
extra: its failures are combined before the shuffle and the join's other side
has one row per host (broadcast if small, else split by AQE).

Defined results: a null or blank text has no words and fails the base rule; a
null host has no host verdict; hosts with the same figures get the same verdict;
repeated rows count and return once each; a very long text is split into words
in its own row (about ten times its bytes); an empty table returns no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import let, stored

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class HostRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5  # hosts whose shrunk failure rate reaches it are rejected
    max_strength: float = 1000.0  # of the prior, in documents; also used if hosts do not differ


def repeated_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that are found twice or more in ``words``.

    Windows are named by a 64-bit hash, sorted with their start; neighbours of
    equal name are repeats; the starts' 3-word spans are then merged.
    """
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = F.transform(s, lambda x, j: F.when(
            (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"]))
        return F.sort_array(F.filter(same, lambda x: x.isNotNull()))

    covered = F.aggregate(
        let(F.sort_array(grams), starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n"), (i + 3).alias("end")))
    return F.coalesce(covered["n"], F.lit(0)).cast("long")


def document_counts(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """doc_id, host, the counts and ``base_failed`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.col("source").alias("host"), text.alias("text")).select(
        "*", F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    counts = words.select("*", F.size("words").alias("n")).select(
        "doc_id", "host", F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("n")).alias("n_repeat_words"))
    return counts.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))


def host_prior(hosts: DataFrame, rules: HostRules) -> tuple[float, float]:
    """Mean and strength (in documents) of the beta prior, by moments over all hosts.

    One aggregate row reaches the driver.
    """
    r = hosts.agg(F.count("*").alias("h"), F.sum("n").alias("n"), F.sum("k").alias("k"),
                  F.round(F.sum(F.col("k") * F.col("k") / F.col("n")), 6).alias("q")).first()
    if not r["n"]:
        return 0.0, rules.max_strength
    mean = r["k"] / r["n"]
    spread = mean * (1 - mean)
    excess = (r["q"] - r["k"] * r["k"] / r["n"]) / r["n"] - spread * (r["h"] - 1) / r["n"]
    strength = spread / excess - 1 if excess > 0 else rules.max_strength
    return mean, round(min(max(strength, 1.0), rules.max_strength), 3)


def host_verdicts(counts: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """host, n, k, host_rate (shrunk) and host_rejected of every host that has a name."""
    hosts = stored(counts.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k")), "hosts")
    mean, strength = host_prior(hosts, rules)
    rate = (F.col("k") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "k", rate.alias("host_rate"), (rate >= rules.max_host_rate).alias("host_rejected"))


def quality_rules(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    counts = stored(document_counts(docs, rules), "rules")
    verdicts = host_verdicts(counts, rules).select("host", "host_rejected")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return counts.join(verdicts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"), rejected.alias("host_rejected"))
