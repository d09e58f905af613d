"""Language identification by hyperdimensional profiles (operator 12).

Every letter (any code point of a letter category, lower case; a stretch of
anything else is one blank) has a random vector of DIMENSIONS signs, made from
its code point by a fixed hash. A trigram binds its letters: the first one's
vector rotated by two places times the second one's rotated by one times the
third one's. A text is the sum (bundle) of its trigrams' vectors, a language
the sum of its documents' bundles, each divided by its number of trigrams, so
long documents do not outweigh others. Texts take the language of the highest
cosine; the score is that cosine, 0 if negative.

Prototypes are learned from all documents with a language that are not held
out: a task adds up trigram weights (whole numbers, so sums do not depend on
their order), turns them into vectors and emits one row per language. Only the prototypes (languages x DIMENSIONS numbers) pass
through the driver; a language is a value of ``lang``, a set that does not
grow with the documents.

A text is bundled by matrix products of its trigram counts, trigram vectors are
made for TRIGRAMS trigrams at a time. A text takes about 40 bytes of memory a
byte at peak; texts above PART_BYTES are handled alone.

Defined results: null texts, and those without a letter, are ``und`` with
score 0, as is every text if there is nothing to learn from; ties go to the
smaller language; null languages are not learned; a null doc_id is kept, not
held out and learned from; repeated rows return once each and count once each;
empty tables return no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices
from clickmart.llm.words import U, mix

DIMENSIONS = 1024
PART_BYTES = 1 << 20
TEXTS = 64  # texts bundled by one product
TRIGRAMS = 8192  # trigram vectors held at a time
DENSE_LETTERS = 128  # up to so many letters trigrams are numbered by a table
WEIGHT = 1 << 24  # what the trigrams of one learned document weigh together (more only beyond as many trigrams)
TASK_TRIGRAMS = 500_000  # trigram weights a learning task holds
CACHE_LETTERS = 4096
UNDEFINED = "und"
CODE = np.int64(21)  # bits of a code point
MASK = np.int64((1 << 21) - 1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, trigram) of every trigram of the texts that hold a letter; a trigram packs three code points, 0 for a blank."""
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *lower, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lower]) if texts else np.zeros(0, np.int64)
    row = np.append(row, max(len(texts) - 1, 0))[:len(codes)]
    codes = np.where(_letters()[codes], codes, 0)
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes, row = codes[kept], row[kept]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = codes[1:-1] != 0  # no trigram stands across a blank
    return row[1:-1][inside], ((codes[:-2] << 2 * CODE) | (codes[1:-1] << CODE) | codes[2:])[inside]


_SIGNS: dict[int, np.ndarray] = {}


def signs(letter: int) -> np.ndarray:
    """The random vector of a letter."""
    if letter not in _SIGNS:
        if len(_SIGNS) > CACHE_LETTERS:
            _SIGNS.clear()
        bits = mix(mix(np.arange(DIMENSIONS // 64, dtype=U) + U(letter) * U(DIMENSIONS)) + U(0x9E3779B97F4A7C15))
        _SIGNS[letter] = (2 * np.unpackbits(bits.view(np.uint8)).astype(np.int8) - 1).astype(np.int8)
    return _SIGNS[letter]


def vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vectors of trigrams."""
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in (2, 1, 0):
        letters, which = np.unique((grams >> place * CODE) & MASK, return_inverse=True)
        out *= np.stack([np.roll(signs(int(c)), place) for c in letters])[which]
    return out


def _held_at_a_time(grams: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    for lo in range(0, len(grams), TRIGRAMS):
        yield slice(lo, lo + TRIGRAMS), vectors(grams[lo:lo + TRIGRAMS]).astype(np.float32)


def numbered(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams in order, and which of them each one is."""
    used = np.zeros(1 << CODE, bool)
    for place in (2, 1, 0):
        used[(gram >> place * CODE) & MASK] = True
    letters = np.flatnonzero(used)
    k = len(letters)
    if k > DENSE_LETTERS:
        return np.unique(gram, return_inverse=True)
    number = np.zeros(1 << CODE, np.int64)
    number[letters] = np.arange(k)
    dense = (number[gram >> 2 * CODE] * k + number[(gram >> CODE) & MASK]) * k + number[gram & MASK]
    there = np.zeros(k ** 3, bool)
    there[dense] = True
    found = np.flatnonzero(there)
    grams = (letters[found // (k * k)] << 2 * CODE) | (letters[found // k % k] << CODE) | letters[found % k]
    rank = np.zeros(k ** 3, np.int32)
    rank[found] = np.arange(len(found))
    return grams, rank[dense]


def bundles(row: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """n x DIMENSIONS sums of the vectors of each row's trigrams; row is sorted."""
    out = np.zeros((n, DIMENSIONS))
    grams, which = numbered(gram)
    at = np.searchsorted(row, np.arange(0, n + TEXTS, TEXTS))
    for part, bound in _held_at_a_time(grams):
        size = len(bound)
        for k, lo in enumerate(range(0, n, TEXTS)):
            own, rows = which[at[k]:at[k + 1]] - part.start, min(TEXTS, n - lo)
            text = row[at[k]:at[k + 1]] - lo
            if size < len(grams):
                inside = (own >= 0) & (own < size)
                own, text = own[inside], text[inside]
            if len(own):
                counts = np.bincount(text * size + own, minlength=rows * size).reshape(rows, size)
                some = np.flatnonzero(counts.any(0))
                exact = np.float32 if len(own) < 1 << 24 else np.float64
                out[lo:lo + rows] += counts[:, some].astype(exact) @ bound[some].astype(exact, copy=False)
    return out


@dataclass
class Profiles:
    """Languages, in order, and their prototypes of length one."""

    languages: list[str]
    prototypes: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text."""
        row, gram = trigrams(texts)
        found, score = [UNDEFINED] * len(texts), np.zeros(len(texts))
        if self.languages and len(row):
            bundle = bundles(row, gram, len(texts))
            length = np.sqrt((bundle * bundle).sum(1))
            cosine = np.round(bundle @ self.prototypes.T / np.where(length > 0, length, 1)[:, None], 9)
            best = cosine.argmax(1)
            for i in np.unique(row).tolist():
                found[i] = self.languages[best[i]]
                score[i] = min(1.0, max(0.0, cosine[i, best[i]]))
        return found, score


def learn(docs: DataFrame) -> Profiles:
    """Profiles of the languages of all rows (text, lang)."""
    def run(batches):
        sums: dict[str, dict[int, int]] = {}

        def out():
            for lang, weights in sums.items():
                grams, weight = np.array(list(weights), np.int64), np.array(list(weights.values()), np.int64)
                total = np.zeros(DIMENSIONS, np.int64)
                for part, bound in _held_at_a_time(grams):
                    total += np.rint(weight[part].astype(np.float64) @ bound.astype(np.float64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total], pa.list_(pa.int64()))], names=["lang", "total"])

        for batch in slices(batches, size=PART_BYTES):
            names, lang = np.unique(np.array(column(batch, "lang").to_pylist(), str), return_inverse=True)
            row, gram = trigrams(column(batch, "text").to_pylist())
            if not len(row):
                continue
            weight = np.maximum(1, WEIGHT // np.maximum(np.bincount(row, minlength=batch.num_rows), 1))
            grams, which = numbered(gram)
            for i in np.unique(lang[row]).tolist():
                own = lang[row] == i
                total = np.bincount(which[own], weight[row[own]], len(grams)).astype(np.int64)
                held, at = sums.setdefault(str(names[i]), {}), np.flatnonzero(total)
                for g, w in zip(grams[at].tolist(), total[at].tolist(), strict=True):
                    held[g] = held.get(g, 0) + w
            if sum(map(len, sums.values())) > TASK_TRIGRAMS:
                yield from out()
                sums.clear()
        yield from out()

    rows = docs.where(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInArrow(run, "lang string, total array<bigint>")
    sums = parts.select("lang", F.posexplode("total").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).getField("n").alias("total")).toArrow().sort_by("lang")
    sums = np.array(found["total"].to_pylist(), np.float64).reshape(-1, DIMENSIONS)
    length = np.sqrt((sums * sums).sum(1, keepdims=True))
    return Profiles(found["lang"].to_pylist(), sums / np.where(length > 0, length, 1))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        for batch in slices(batches, size=PART_BYTES):
            found, score = shared.value.predict(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def _held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """Every row's predicted language, learned from the rows that are not held out."""
    profiles = learn(docs.where(~_held_out()))
    return identify(docs, profiles).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
