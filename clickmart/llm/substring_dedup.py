"""Exact removal of long repeated word runs by recompression (operator 3).

Recompression names ever longer pieces of every text: a round first names runs
of equal symbols, then pairs whose left symbol falls in one half of the
alphabet and whose right symbol in the other (by a hash bit). Names are hashes
of content, so all tasks agree on them, and what a round does inside a window
depends on the window alone except at its two edges. So equal windows share
the symbols of their interior after ROUNDS rounds. A window's anchor is its
least interior group of GROUP symbols (of a lower round where runs left fewer).

1. Anchors that occur in two texts, or twice in one, are counted by a partial
   aggregate; only windows with such an anchor can repeat.
2. These windows are named in full (96 bits), and names that occur twice mark
   the words they cover. Nothing is sampled and no pairs are formed.

Rows of one text are decided on one representative: a text of WINDOW words or
more that occurs twice is covered whole, and its copies never reach step 2.

Defined results: null, empty and short texts keep all words; repeated rows are
copies and lose all words if long enough, with or without a doc_id; very long
texts are handled whole in one task, at about 33 bytes of memory a byte; empty
tables return no rows; other columns are ignored (``report``) or kept
(``remove_repeats``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices, stored, text_name
from clickmart.llm.words import U, Words, mix, spans_names

WINDOW = 35
ROUNDS = 3
GROUP = 3
POSITION = U(31)  # low bits that hold a position where hash and position share a word


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def _round(level: int, sym, start, doc, left, right):
    """Names runs, then pairs. [left, right) are the symbols of each window that its own words decide."""
    n = len(sym)
    new = np.ones(n, bool)
    new[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    run = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, n))
    sym = np.where(length > 1, mix(sym[at] + mix(length.astype(U))), sym[at])
    start, doc = start[at], doc[at]
    some = right > left
    left, right = np.where(some, run[np.minimum(left, n - 1)] + 1, 0), np.where(some, run[right - 1], 0)

    n = len(sym)
    high = (mix(sym + U(level)) & U(1)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = ~high[:-1] & high[1:] & (doc[:-1] == doc[1:])
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    to = np.cumsum(~second) - 1
    some = right > left
    left = np.where(some, left + high[np.minimum(left, n - 1)], 0)
    right = np.where(some, right - ~high[right - 1], 0)
    some = right > left
    left, right = np.where(some, to[np.minimum(left, n - 1)], 0), np.where(some, to[right - 1] + 1, 0)
    joined = mix(sym[:-1] * U(0x9E3779B97F4A7C15) + mix(sym[1:])) if n > 1 else sym[:0]
    sym = np.where(pair, np.append(joined, U(0)), sym)[~second]
    return sym, start[~second], doc[~second], left, right


def _least(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of keys[low..high] for many ranges."""
    out = np.empty(len(low), U)
    power = np.frexp(high - low + 1)[1] - 1
    table = keys
    for k in range(int(power.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = power == k
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k) + 1])
    return out


def anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, anchor name and the anchor's first word of every window of the texts."""
    first = words.windows(window)
    n = len(words.doc)
    state = (words.names(), np.arange(n), words.doc, first, first + window)
    levels = [state]
    for level in range(1, ROUNDS + 1):
        if len(first):
            state = _round(level, *state)
            levels.append(state)
    name, place, open_ = np.zeros(len(first), U), np.zeros(len(first), np.int64), np.ones(len(first), bool)
    for level, (sym, start, _, left, right) in reversed(list(enumerate(levels))):
        own = np.flatnonzero(open_ & (right - left >= GROUP))
        if len(own):
            group = sym[:len(sym) - GROUP + 1] + U(level)
            for k in range(1, GROUP):
                group = mix(group * U(0xC2B2AE3D27D4EB4F) + sym[k:len(sym) - GROUP + 1 + k])
            keys = ((group >> POSITION) << POSITION) | np.arange(len(group), dtype=U)
            least = (_least(keys, left[own], right[own] - GROUP) & ((U(1) << POSITION) - U(1))).astype(np.int64)
            name[own], place[own] = group[least], start[least]
            open_[own] = False
    return first, name, place


def shared_anchors(docs: DataFrame, window: int, text: Column) -> DataFrame:
    """t (text), names: the anchors of each text that other texts have too, or that it has twice."""
    def run(batches):
        for batch in slices(batches):
            words = Words(column(batch, "text"))
            first, name, place = anchors(words, window)
            doc = words.doc[first]
            # neighbouring windows share an anchor; it is in the text twice if it stands at two places
            new = np.ones(len(first), bool)
            new[1:] = (place[1:] != place[:-1]) | (name[1:] != name[:-1])
            doc, name = doc[new], name[new]
            order = np.lexsort((name, doc))
            d, a = doc[order], name[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1])
            at = np.flatnonzero(new)
            twice = np.diff(np.append(at, len(d))) > 1
            t = column(batch, "t").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at].view(np.int64)), pa.array(t[d[at]]), pa.array(twice)], names=["name", "t", "twice"])

    found = stored(docs.select(text.alias("t"), "text").mapInArrow(run, "name long, t long, twice boolean"), "anchors")
    shared = found.groupBy("name").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.max("twice").alias("twice")).where(
        "low <> high or twice").select("name")
    return found.join(shared, "name").groupBy("t").agg(F.collect_set("name").alias("names"))


def repeated_windows(docs: DataFrame, window: int, text: Column) -> DataFrame:
    """t and starts (first words, sorted) of the windows that occur twice; one row per text."""
    rows = docs.select(text.alias("t"), _row().alias("r"), "text")
    ones = rows.groupBy("t").agg(F.min("r").alias("r"))
    lists = stored(shared_anchors(docs, window, text).join(ones, "t"), "lists")

    def run(batches):
        for batch in slices(batches):
            words = Words(column(batch, "text"))
            first, name, _ = anchors(words, window)
            names = column(batch, "names")
            doc = words.doc[first]
            wanted = mix(names.flatten().to_numpy().view(U) + U(1)) + np.repeat(
                np.arange(batch.num_rows), names.value_lengths().to_numpy()).astype(U)
            some = np.isin(mix(name + U(1)) + doc.astype(U), wanted)
            first, doc = first[some], doc[some]
            one = spans_names(words.names(), first, first + window)
            two = spans_names(words.names(1), first, first + window, 1)
            t = column(batch, "t").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.astype(np.uint32).view(np.int32)), pa.array(t[doc]),
                 pa.array((first - words.first[doc]).astype(np.int32))], names=["one", "two", "t", "pos"])

    found = rows.join(lists, ["t", "r"]).select("t", "text", "names").mapInArrow(run, "one long, two int, t long, pos int")
    found = stored(found, "windows")
    again = found.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    return found.join(again, ["one", "two"]).groupBy("t").agg(F.sort_array(F.collect_list("pos")).alias("starts"))


def decisions(docs: DataFrame, window: int, text: Column) -> DataFrame:
    """t, r, whole, starts: what is removed from the rows that lose anything; other rows are absent."""
    rows = docs.select(text.alias("t"), _row().alias("r"))
    copied = stored(rows.groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select("t"), "copied")
    parts = stored(repeated_windows(docs, window, text), "starts")
    whole = rows.join(copied, "t").distinct().select("t", "r", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("starts"))
    single = rows.join(parts, "t").join(copied, "t", "left_anti").select("t", "r", F.lit(False).alias("whole"), "starts")
    return whole.unionByName(single)


def _gone(words: Words, row: int, whole: bool | None, starts, window: int) -> np.ndarray:
    """Which of the row's words are removed."""
    n = int(words.count[row])
    if whole:
        return np.full(n, n >= window)
    edge = np.zeros(n + 1, np.int64)
    if starts is not None and len(starts):
        np.add.at(edge, starts, 1)
        np.add.at(edge, np.asarray(starts) + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _decided(docs: DataFrame, window: int) -> DataFrame:
    """row (all columns), text, whole, starts."""
    text = text_name(docs)
    d = stored(decisions(docs, window, text), "decisions").withColumnsRenamed({"t": "_t", "r": "_r"})
    rows = docs.select(F.struct("*").alias("row"), "text", text.alias("t"), _row().alias("r"))
    return rows.join(d, (F.col("t") == F.col("_t")) & (F.col("r") == F.col("_r")), "left").select("row", "text", "whole", "starts")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words."""
    def run(batches):
        for batch in slices(batches):
            words, rows = Words(column(batch, "text")), []
            data = words.data.tobytes()
            whole, starts = column(batch, "whole").to_pylist(), column(batch, "starts")
            for i in range(batch.num_rows):
                gone = _gone(words, i, whole[i], starts[i].values.to_numpy() if starts[i].is_valid else None, window)
                text = data[words.begins[i]:words.begins[i + 1]]
                if gone.any():
                    at = words.first[i] + np.flatnonzero(~gone)
                    kept = [data[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)]
                else:
                    kept = text.split()
                rows.append((len(gone), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, g, h = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(g, pa.int64()), pa.array(h)],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _decided(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), window).select(
        "row.doc_id", "text", "whole", "starts").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without their repeated words; what stays keeps its white space, and n_chars (if there) is counted anew."""
    def run(batches):
        for batch in slices(batches):
            words, texts = Words(column(batch, "text")), column(batch, "text").to_pylist()
            data = words.data.tobytes()
            whole, starts = column(batch, "whole").to_pylist(), column(batch, "starts")
            for i in range(batch.num_rows):
                gone = _gone(words, i, whole[i], starts[i].values.to_numpy() if starts[i].is_valid else None, window)
                if gone.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    begins = np.append(words.start[words.first[i]:words.first[i + 1]], words.begins[i + 1])
                    parts, at = [], words.begins[i]
                    for a, b in zip(begins[edge[::2]], begins[edge[1::2]], strict=True):
                        parts.append(data[at:a])
                        at = b
                    texts[i] = b"".join([*parts, data[at:words.begins[i + 1]]]).decode()
            yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array(texts, pa.string())], names=["row", "text"])

    decided = _decided(docs, window)
    kind = decided.select("row", "text").schema
    out = decided.mapInArrow(run, kind)
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
