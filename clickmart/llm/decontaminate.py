"""Benchmark decontamination with an Aho-Corasick automaton (operator 5).

Benchmark texts are normalised to words; each run of WINDOW words (a shorter
item whole) is a pattern with blanks around it. One automaton over all
patterns reads each normalised document once and finds every pattern; matches
become words of the document and, from there, offsets in the original text.

The automaton of a block holds at most BLOCK_CHARS characters of patterns. A
larger benchmark is dealt into several blocks by item, and the documents are
read once a block; this is the way beyond the bound, and nothing is left out.

Defined results: null, empty or word-free texts have 0 words and are clean; a
null or word-free item is no pattern; a null item_id is matched but not named;
items with equal windows are all reported; repeated rows return once each;
very long texts are read whole, alone if above SLICE_BYTES; a very long item is
one block by itself, at about 50 bytes of memory a character of its windows;
empty tables return no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices, stored

WINDOW = 13
HIT_SHARE = 20  # contaminated if n_hit * HIT_SHARE >= n_words
BLOCK_CHARS = 4 << 20  # an automaton of so many takes about 200 MB in a task
# A-Z to a-z; 0-9, a-z and bytes of non-ASCII characters stay; the rest are blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^ ]+")
_AUTOMATA: dict = {}


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def windows(words: list[bytes], size: int) -> list[str]:
    """Patterns: latin-1 strings, one character a byte, words between single blanks."""
    found = [words[i:i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    return [f" {b' '.join(w).decode('latin-1')} " for w in found]


def _automaton(key: str, items: list[tuple], size: int):
    if key not in _AUTOMATA:
        owners: dict[str, list] = {}
        for item, text in items:
            for w in windows(normal_words(text), size):
                owners.setdefault(w, []).append(item)
        a = ahocorasick.Automaton()
        for w, own in owners.items():
            a.add_word(w, (w.count(" ") - 1, len(w), tuple(x for x in own if x is not None)))
        if owners:
            a.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


def _matches(words: list[bytes], automaton) -> tuple[list[int], set]:
    """Indices of the words inside matches, and the items matched."""
    if not words or not len(automaton):
        return [], set()
    text = f" {b' '.join(words).decode('latin-1')} "
    found, items = [], set()
    for end, (n, size, own) in automaton.iter(text):
        found.append((end - size + 1, n))
        items.update(own)
    if not found:
        return [], items
    blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    at, n = np.array(found).T
    edge = np.zeros(len(words) + 1, np.int64)
    first = np.searchsorted(blanks, at)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + n, -1)
    return np.flatnonzero(np.cumsum(edge[:-1])).tolist(), items


def _blocks(benchmark: DataFrame, size: int, block_chars: int):
    """The benchmark's (item_id, text) in blocks whose patterns fit the bound."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("text").isNotNull())
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars * size / block_chars))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) if n > 1 else rows
        yield b == n - 1, [tuple(r) for r in part.collect()]


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (all its columns, nested as ``row``) with n_words, hits (word indices) and items (item_ids)."""
    spark = docs.sparkSession
    out = docs.select(F.struct("*").alias("row"), F.col("text"), F.lit(None).cast("array<bigint>").alias("hits"),
                      F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n_words"))
    for last, items in _blocks(benchmark, size, block_chars):
        shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def scan(batches, shared=shared, key=key):
            automaton = _automaton(key, shared.value, size)
            for batch in slices(batches):
                rows = []
                for text, hits, found in zip(*(column(batch, c).to_pylist() for c in ("text", "hits", "items")), strict=True):
                    words = normal_words(text)
                    now, new = _matches(words, automaton)
                    rows.append((len(words), sorted({*now, *(hits or ())}), sorted({*new, *(found or ())})))
                n, h, i = (list(c) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "row"), column(batch, "text"), pa.array(h, pa.list_(pa.int64())),
                     pa.array(i, pa.list_(pa.string())), pa.array(n, pa.int64())],
                    names=["row", "text", "hits", "items", "n_words"])

        out = out.mapInArrow(scan, out.schema)
        if not last:
            out = stored(out, "decontaminate")
    return out


def contaminated() -> Column:
    n_hit = F.size("hits")
    return (n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))


def original_spans(text: str | None, hits: list[int]) -> list[tuple[int, int]]:
    """Character ranges of the original text that hold the hit words; neighbouring words form one range."""
    raw = (text or "").encode("utf-8", "replace")
    places = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
    runs: list[list[int]] = []
    for i in hits:
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return [(len(raw[:places[a][0]].decode()), len(raw[:places[b][1]].decode())) for a, b in runs]


def spans(found: DataFrame) -> DataFrame:
    """doc_id, start and end (characters of the original text) of every hit passage of ``find``'s result."""
    def ranges(batches):
        for batch in slices(batches):
            rows = [(d, *s) for d, t, h in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "text", "hits")), strict=True)
                    for s in original_spans(t, h)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                             names=["doc_id", "start", "end"])

    hit = found.where(F.size("hits") > 0).select("row.doc_id", "text", "hits")
    return hit.mapInArrow(ranges, "doc_id long, start long, end long")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    return find(docs, benchmark).where(~contaminated()).select("row.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with its counts and verdict."""
    return find(docs.select("doc_id", "text"), benchmark).select(
        "row.doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
