"""Removal of repeated byte strings by column-wise suffix sorting (operator 8).

A byte goes if it is covered by a string of LENGTH bytes that also starts
earlier (smaller doc_id, or the same document at an earlier byte).

1. The anchor of a string is its least GRAM-byte piece by a hash, so equal
   strings have equal anchors. Anchors that occur in two texts, or twice in
   one, are found by a partial aggregate; other strings cannot repeat.
2. Neighbouring strings of one anchor form a context (at most 2 * LENGTH - GRAM
   bytes). Equal contexts are collapsed by an aggregate: all but the first go.
3. Different contexts of one anchor are compared by their suffixes. A task
   takes a collection of contexts (whole anchors, about COLLECTION), lines them
   up by their anchors and builds the transform and common prefixes column by
   column: each round inserts one symbol of every context, reading the last
   round's file in sequence and writing the next. Strings with a common prefix
   of LENGTH are equal; all but the first go.
4. An anchor with more than ANCHOR_CONTEXTS different contexts would be too
   much for one task; its strings are grouped by their own digest instead, of
   contexts that agree with another in the anchor and half of the rest on one
   side of it (equal strings do).

Copies of a whole text are represented by the one of least doc_id; the others
lose all bytes if they have LENGTH of them.

Defined results: null and short texts keep all bytes; a null doc_id comes
last; rows that repeat doc_id and text are one document and decided alike; very
long texts are handled whole in one task, at about 72 bytes of memory a byte;
empty tables return no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices, stored, text_name
from clickmart.llm.words import U, _bytes_names, mix, spans_names

LENGTH = 100
GRAM = 24
COLLECTION = 8192
ANCHOR_CONTEXTS = 2048
POSITION = U(31)  # low bits that hold a position where hash and position share a word
LAST = (1 << 63) - 1


def _order() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(LAST))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (and the last ends)."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    return np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8), at - at[0]


def contexts(data: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """row, name, place, first, last: the anchors and the range of string starts that each one serves."""
    n = len(data) - length + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty.astype(U), empty, empty, empty
    grams = np.arange(len(data) - GRAM + 1)
    name = spans_names(_bytes_names(0)[data], grams, grams + GRAM)
    table = ((name >> POSITION) << POSITION) | grams.astype(U)
    width = length - GRAM + 1
    step = 1
    while 2 * step <= width:
        table = np.minimum(table[:-step], table[step:])
        step *= 2
    least = np.minimum(table[:n], table[width - step:width - step + n])
    place = (least & ((U(1) << POSITION) - U(1))).astype(np.int64)
    row = np.searchsorted(begins, np.arange(n), "right") - 1
    whole = np.flatnonzero(begins[row + 1] >= np.arange(n) + length)
    place, row = place[whole], row[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], name[place[at]], place[at], whole[at], whole[np.append(at[1:], len(whole)) - 1] if len(at) else empty


def shared_anchors(docs: DataFrame, length: int, text: Column) -> DataFrame:
    """t (text), names: the anchors of each text that other texts have too, or that it has twice."""
    def run(batches):
        for batch in slices(batches):
            row, name, _, _, _ = contexts(*_bytes(column(batch, "text")), length)
            order = np.lexsort((name, row))
            d, a = row[order], name[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1])
            at = np.flatnonzero(new)
            twice = np.diff(np.append(at, len(d))) > 1
            t = column(batch, "t").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(a[at].view(np.int64)), pa.array(t[d[at]]), pa.array(twice)],
                                             names=["name", "t", "twice"])

    found = stored(docs.select(text.alias("t"), "text").mapInArrow(run, "name long, t long, twice boolean"), "anchors")
    shared = stored(found.groupBy("name").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.max("twice").alias("twice")).where(
        "low <> high or twice").select("name"), "shared")
    return found.join(shared, "name").groupBy("t").agg(F.collect_set("name").alias("names"))


OCCURRENCE = "name long, same long, o long, t long, first int, last int, lead int, bytes binary"


def occurrences(docs: DataFrame, length: int, text: Column) -> DataFrame:
    """One row per shared anchor and place: name, same (digest of the context), o (doc_id), t, string starts, bytes."""
    rows = docs.select(text.alias("t"), _order().alias("o"), "text")
    ones = rows.groupBy("t").agg(F.min("o").alias("o"))
    lists = stored(shared_anchors(docs, length, text).join(ones, "t"), "lists")

    def run(batches):
        for batch in slices(batches):
            data, begins = _bytes(column(batch, "text"))
            row, name, place, first, last = contexts(data, begins, length)
            names = column(batch, "names")
            wanted = mix(names.flatten().to_numpy().view(U) + U(1)) + np.repeat(
                np.arange(batch.num_rows), names.value_lengths().to_numpy()).astype(U)
            some = np.isin(mix(name + U(1)) + row.astype(U), wanted)
            row, name, place, first, last = (x[some] for x in (row, name, place, first, last))
            same = mix(spans_names(_bytes_names(1)[data], first, last + length, 1) + (place - first).astype(U))
            t, o = column(batch, "t").to_numpy(), column(batch, "o").to_numpy()
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(same.view(np.int64)), pa.array(o[row]), pa.array(t[row]),
                 *(pa.array(x.astype(np.int32)) for x in (first - begins[row], last - begins[row], place - first)),
                 pa.array([raw[a:b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)], pa.binary())],
                names=[c.split()[0] for c in OCCURRENCE.split(", ")])

    return rows.join(lists, ["t", "o"]).select("t", "o", "text", "names").mapInArrow(run, OCCURRENCE)


class Columns:
    """The newest column of a collection's transform in a file: symbols, common prefixes, texts. A round reads it and writes the next."""

    KINDS = (np.uint16, np.uint16, np.int32)

    def __init__(self, folder: str):
        self.file = open(Path(folder, "columns"), "w+b")  # every round is as long, so opened once

    def read(self) -> list[np.ndarray]:
        self.file.seek(0)
        data = self.file.read()
        n = len(data) // sum(np.dtype(k).itemsize for k in self.KINDS)
        out, at = [], 0
        for k in self.KINDS:
            out.append(np.frombuffer(data, k, n, at))
            at += out[-1].nbytes
        return out

    def write(self, *values: np.ndarray) -> None:
        self.file.seek(0)
        for v, k in zip(values, self.KINDS, strict=True):
            self.file.write(np.ascontiguousarray(v, k).data)


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high] for many ranges, none empty."""
    power = np.frexp(high - low + 1)[1] - 1
    out, table = np.empty(len(low), values.dtype), values
    for k in range(int(power.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = np.flatnonzero(power == k)
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k) + 1])
    return out


def sort_columns(texts: list[bytes], leads: np.ndarray, cap: int, folder: str):
    """Per round, from the last column to the first: column, texts in order, common prefix with the one before (up to cap).

    The texts stand one below the other with their anchors (``leads`` bytes
    from each start) in column 0. A round inserts the symbol that each text
    has in the next column to the left: the stable order of these symbols in
    the transform is the order of the longer suffixes, and a common prefix is
    one more than the least between two equal symbols. Suffixes of different
    columns are never compared, as equal strings hold their anchor at the
    same place. A text without a symbol in a column stands first, with
    common prefix 0.
    """
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    left = int(leads.max(initial=0))
    width = left + int((size - leads).max(initial=0))
    of = np.repeat(np.arange(n), size)
    within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    symbols = np.zeros((width + 1, n), np.uint16)  # row 0: none, before the first column
    symbols[1 + left - leads[of] + within, of] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
    files = Columns(folder)
    files.write(symbols[width], np.zeros(n), np.arange(n))
    for c in range(width, 0, -1):
        bwt, lcp, text = files.read()
        order = np.argsort(bwt, kind="stable")
        symbol, text = bwt[order], text[order]
        prefix = np.zeros(n, np.int64)
        equal = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)) + 1
        prefix[equal] = np.minimum(_range_least(lcp, order[equal - 1] + 1, order[equal]).astype(np.int64) + 1, cap)
        files.write(symbols[c - 1][text], prefix, text)
        yield c - 1 - left, text, prefix
    files.file.close()


def repeated_strings(texts: list[bytes], leads: np.ndarray, order: np.ndarray, length: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Text and start of every string of ``length`` that equals one of lower order; order + start: place in the corpus."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for c, text, prefix in sort_columns(texts, leads, length, folder):
        first = np.flatnonzero(prefix < length)
        if c > 0 or len(first) == len(text):  # a string starts at its anchor or before
            continue
        start = leads[text] + c
        rank = order[text] + start
        least = np.minimum.reduceat(rank, first)
        gone = rank > np.repeat(least, np.diff(np.append(first, len(text))))
        found.append((text[gone], start[gone]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def compare_contexts(rows: DataFrame, length: int) -> DataFrame:
    """t, first, last: string starts that repeat an earlier string; rows: different contexts, dealt by name."""
    def collections(frames):
        """Frames of whole anchors: about COLLECTION contexts each, and one anchor more at most."""
        held = None
        for pdf in frames:
            for lo in range(0, len(pdf), COLLECTION):
                part = pdf.iloc[lo:lo + COLLECTION]
                held = part if held is None else pd.concat([held, part])
                name = held["name"].to_numpy()
                ends = np.flatnonzero(name[1:] != name[:-1]) + 1
                if len(ends):
                    yield held.iloc[:ends[-1]]
                    held = held.iloc[ends[-1]:]
        if held is not None:
            yield held

    def run(frames):
        for pdf in collections(frames):
            # places in (o, t, byte) order; equal documents are apart by their rank, far enough for any start
            doc = pdf.groupby(["o", "t"], sort=True).ngroup().to_numpy().astype(np.int64)
            at = (doc << 40) + pdf["first"].to_numpy()
            with tempfile.TemporaryDirectory() as folder:
                text, start = repeated_strings(pdf["bytes"].tolist(), pdf["lead"].to_numpy().astype(np.int64), at, length, folder)
            order = np.lexsort((start, text))
            text, start = text[order], start[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(text)) - 1 if len(a) else a
            base = pdf["first"].to_numpy()[text[a]]
            yield pd.DataFrame({"t": pdf["t"].to_numpy()[text[a]], "first": (base + start[a]).astype(np.int32),
                                "last": (base + start[b]).astype(np.int32)})

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "name").sortWithinPartitions("name")
    return dealt.select("name", "o", "t", "first", "lead", "bytes").mapInPandas(run, "t long, first int, last int")


def compare_strings(rows: DataFrame, length: int) -> DataFrame:
    """As compare_contexts, by a digest of every string: for anchors with too many contexts for one task."""
    strings = rows.select("o", "t", F.explode(F.sequence("first", "last")).alias("s"), "first", "bytes").select(
        "o", "t", "s", F.unhex(F.md5(F.expr(f"substring(bytes, s - first + 1, {length})"))).alias("string"))
    strings = stored(strings, "strings")
    firsts = stored(strings.groupBy("string").agg(F.min(F.struct("o", "t", "s")).alias("one"), F.count("*").alias("n")).where(
        "n > 1").select("string", "one"), "first_strings")
    return strings.join(firsts, "string").where(F.struct("o", "t", "s") > F.col("one")).select(
        "t", F.col("s").alias("first"), F.col("s").alias("last"))


def similar_contexts(heads: DataFrame, length: int) -> DataFrame:
    """The contexts that share, with another of their anchor, the anchor and what a string must have before or after it.

    A string holds its anchor and length - GRAM further bytes, so half of them stand on one side.
    """
    half = (length - GRAM) // 2
    before = F.when(F.col("lead") >= half, F.expr(f"xxhash64(1, substring(bytes, lead - {half} + 1, {half + GRAM}))"))
    after = F.when(F.col("last") - F.col("first") >= F.col("lead") - half, F.expr(f"xxhash64(2, substring(bytes, lead + 1, {half + GRAM}))"))
    sides = stored(heads.select("name", "same", F.explode(F.array(before, after)).alias("side")).where(F.col("side").isNotNull()), "sides")
    shared = stored(sides.groupBy("name", "side").agg(F.count("*").alias("n")).where("n > 1").select("name", "side"), "shared_sides")
    kept = sides.join(shared, ["name", "side"]).select("name", "same").distinct()
    return heads.join(kept, ["name", "same"], "left_semi")


def repeated_ranges(docs: DataFrame, length: int, text: Column) -> DataFrame:
    """t, ranges: of string starts that go, of the representative of each text."""
    found = stored(occurrences(docs, length, text), "occurrences")
    firsts = stored(found.groupBy("name", "same").agg(F.min(F.struct("o", "t", "first")).alias("one")), "firsts")
    later = found.select("name", "same", "o", "t", "first", "last").join(firsts, ["name", "same"]).where(
        F.struct("o", "t", "first") > F.col("one")).select("t", "first", "last")
    many = stored(firsts.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), "many")
    heads = firsts.join(many, "name").select("name", "same", "one.*", "n")
    heads = stored(found.join(heads, ["name", "same", "o", "t", "first"]).dropDuplicates(["name", "same"]), "heads")
    parts = [later, compare_contexts(heads.where(F.col("n") <= ANCHOR_CONTEXTS), length),
             compare_strings(similar_contexts(heads.where(F.col("n") > ANCHOR_CONTEXTS), length), length)]
    ranges = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return ranges.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the remaining bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    name = text_name(docs)
    ranges = repeated_ranges(docs, length, name)
    rows = docs.select(name.alias("t"), _order().alias("o"))
    copied = stored(rows.groupBy("t").agg(F.min("o").alias("one"), F.max("o").alias("high")), "texts")
    whole = rows.join(copied.where("one <> high").select("t", "one"), "t").where("o > one").distinct().select(
        F.col("t").alias("_t"), F.col("o").alias("_o"), F.lit(True).alias("whole"),
        F.lit(None).cast("array<struct<first:int,last:int>>").alias("ranges"))
    single = ranges.join(copied, "t").select(
        F.col("t").alias("_t"), F.col("one").alias("_o"), F.lit(False).alias("whole"), "ranges")
    decided = stored(whole.unionByName(single), "decided")

    def run(batches):
        for batch in slices(batches):
            data, begins = _bytes(column(batch, "text"))
            raw, whole, ranges, out = data.tobytes(), column(batch, "whole").to_pylist(), column(batch, "ranges"), []
            for i in range(batch.num_rows):
                text = raw[begins[i]:begins[i + 1]]
                spans: list[list[int]] = []
                if whole[i] and len(text) >= length:
                    spans = [[0, len(text)]]
                elif ranges[i].is_valid:
                    own = ranges[i].values
                    for a, b in zip(own.field(0).to_pylist(), own.field(1).to_pylist(), strict=True):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b + length)
                        else:
                            spans.append([a, b + length])
                digest, at = hashlib.sha256(), 0
                for a, b in [*spans, [len(text), len(text)]]:
                    digest.update(text[at:a])
                    at = b
                out.append((len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = docs.select("doc_id", "text", name.alias("t"), _order().alias("o")).join(
        decided, (F.col("t") == F.col("_t")) & (F.col("o") == F.col("_o")), "left")
    return joined.select("doc_id", "text", "whole", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
