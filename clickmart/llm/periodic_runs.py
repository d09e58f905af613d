"""Maximal periodic runs of words by string synchronising sets (operator 13).

A run is a stretch of words with least period q and at least EXPONENT * q words
that cannot be made longer with that period. Texts of a batch stand in one
array of word numbers, a number of its own after each text, so no run leaves
its text.

1. Periods up to SMALL are read off directly: where word i equals word i + q.
2. At scale t = 4, 8, 16, ... a position is in the synchronising set if the
   least hash of the t-word strings that start in [i, i + t] belongs to i or
   i + t. Strings inside a known region of period up to t / 4 take no part
   (their runs are there already), which keeps the set sparse. The choice looks
   at the 2t words from i alone, so equal contexts are chosen alike.
3. Inside a run with t <= q < 2t every t positions hold a chosen one, and its
   2t words return exactly q words later and not before. So neighbouring equal
   contexts at a distance in [t, 2t) propose all periods of the scale;
   proposals of one distance that touch are merged, compared word for word and
   extended to both sides, which takes steps bounded by t.
4. A region that was found before with a smaller period is dropped.

Words are compared exactly, hashes only choose positions and pair contexts
(64 bits; every pair is compared word for word).

A text is handled in one task, with numpy arrays of its words: about 30 bytes
of memory a byte of text at peak, and texts above SLICE_BYTES are handled alone.

Defined results: null, empty and word-free texts have no runs and an empty
collapsed text; a null doc_id is kept; repeated rows return once each; empty
tables return no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, let, slices
from clickmart.llm.words import U, mix

EXPONENT = 4
LEAST_WORDS = 6
SMALL = 3  # periods that are compared directly; scales start above
NONE = U(0xFFFFFFFFFFFFFFFF)
BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))
FOUND = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in a row, and where each text's words begin (and a last entry)."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2].to_pybytes()[ends[0]:ends[-1]] if len(texts) and ends[-1] > ends[0] else b""
    plain = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data.translate(BLANKS))])
    split = pc.split_pattern(plain, b" ")
    words = split.flatten()
    full = np.asarray(pc.binary_length(words)) > 0
    row = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(split)))[full]
    return np.searchsorted(row, np.arange(len(texts) + 1)), words.filter(pa.array(full))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal stretches of true values."""
    edge = np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` entries (running minima of blocks, from both sides)."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, NONE)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], onward[width - 1:width - 1 + n])


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of strings from the names of their halves."""
    return mix(left * U(0x9E3779B97F4A7C15) + mix(right + U(0xD1B54A32D192ED03)))


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    depth = np.zeros(n + 1, np.int64)
    ok = end > begin
    np.add.at(depth, begin[ok], 1)
    np.add.at(depth, end[ok], -1)
    return np.cumsum(depth[:n]) > 0


def _extended(seq: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, width: int) -> np.ndarray:
    """How many more places from ``at`` in direction ``step`` equal the place a period further, one by one."""
    grown = np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    reach = np.arange(width)
    while len(left):
        place = at[left, None] + step * (grown[left, None] + reach)
        inside = (place >= 0) & (place + period[left, None] < len(seq))
        place = np.where(inside, place, 0)
        same = inside & (seq[place] == seq[np.where(inside, place + period[left, None], 0)])
        whole = same.all(1)
        grown[left] += np.where(whole, width, np.argmin(same, 1))
        left = left[whole]
    return grown


def synchronising(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Chosen positions: names are those of all ``scale``-long strings, periodic the ones that take no part."""
    names = np.where(periodic, NONE, np.minimum(names, NONE - U(1)))
    n = len(names) - scale
    if n <= 0:
        return np.zeros(0, np.int64)
    least = _least(names, scale + 1)
    return np.flatnonzero((least != NONE) & ((least == names[:n]) | (least == names[scale:])))


def _proposals(at: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged stretches [low, high) of places that should equal the place ``period`` further."""
    order = np.argsort(contexts[at], kind="stable")
    place, name = at[order], contexts[at][order]
    period = np.diff(place)
    fits = (name[1:] == name[:-1]) & (period >= scale) & (period < 2 * scale)
    place, period = place[:-1][fits], period[fits]
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    new = np.ones(len(place), bool)
    new[1:] = (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 2 * scale)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    return place[first], place[last] + 2 * scale, period[first]


def _confirmed(seq: np.ndarray, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which stretches hold, word for word."""
    size = high - low
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) + np.repeat(low - begin, size)
    same = seq[place] == seq[place + np.repeat(period, size)]
    return np.logical_and.reduceat(same, begin) if len(size) else np.zeros(0, bool)


def periodic_regions(seq: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, least period) of all maximal regions of at least EXPONENT periods; ``longest``: words of the longest text."""
    n = len(seq)
    start, end, periods = (np.zeros(0, np.int64) for _ in range(3))

    def add(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> None:
        nonlocal start, end, periods
        enough = e - s >= EXPONENT * q
        key, at = np.unique(s[enough] * (n + 1) + e[enough], return_index=True)
        new = at[~np.isin(key, start * (n + 1) + end)]
        start, end, periods = (np.concatenate([x, y[enough][new]]) for x, y in ((start, s), (end, e), (periods, q)))

    for q in range(1, min(SMALL, n - 1) + 1):
        s, e = _stretches(seq[:-q] == seq[q:])
        add(s, e + q, np.full(len(s), q))
    names, scale = mix(seq.astype(U) + U(1)), 1
    while EXPONENT * scale <= longest:
        if scale > SMALL:
            known = periods <= scale // EXPONENT
            at = synchronising(names, scale, _covered(start[known], end[known] - scale + 1, len(names)))
            contexts = _join(names[:-scale], names[scale:])
            low, high, q = _proposals(at, contexts, scale)
            ok = _confirmed(seq, low, high, q)
            low, high, q = low[ok], high[ok], q[ok]
            high = high + _extended(seq, high, q, 1, 2 * scale)
            low = low - _extended(seq, low - 1, q, -1, 2 * scale)
            add(low, high + q, q)
            names = contexts
        else:
            names = _join(names[:-scale], names[scale:])
        scale *= 2
    return start, end, periods


def runs_of(first: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of the runs of many texts, by row, start and period; numbers: equal for equal words."""
    n, words = len(first) - 1, np.diff(first)
    row = np.repeat(np.arange(n), words)
    seq = np.empty(len(numbers) + n, np.int64)
    seq[np.arange(len(numbers)) + row] = numbers
    seq[first[1:] + np.arange(n)] = -1 - np.arange(n)  # after each text a number of its own
    start, end, period = periodic_regions(seq, int(words.max(initial=0)))
    kept = end - start >= LEAST_WORDS
    start, end, period = start[kept], end[kept], period[kept]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    row = np.searchsorted(first[1:] + np.arange(n), start, "left")
    return row, start - first[row] - row, end - start, period


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the text without the words that a run repeats, of every row."""
    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            first, words = words_of(column(batch, "text"))
            row, start, length, period = runs_of(first, words.dictionary_encode().indices.to_numpy(zero_copy_only=False))
            at = np.searchsorted(row, np.arange(n + 1))
            runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]))
            kept = ~_covered(first[row] + start + period, first[row] + start + length, len(words))
            ends = np.concatenate([[0], np.cumsum(kept)])[first]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(kept))), b" ")
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.diff(first), pa.int64()), runs, text.cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the rows, chosen by a hash of doc_id, repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def spread(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        source = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, source(i).cast("int"))), " "))

    text = F.when(F.pmod(h, F.lit(10)) == 0, let(words, spread)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests of all runs and of the collapsed text, of the documents with planted runs."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return periodic_runs(planted(docs)).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
