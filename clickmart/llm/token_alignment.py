"""Alignment of two tokenizers' tokens by diagonal run skipping (operator 11).

Both tokenizers cut the same bytes (a blank and the text), so their tokens are
described by the byte offsets where they end. Offsets that both have cut the
tokens into groups. The two end arrays are walked together: at the current
shift of the two indices, blocks of doubling length are compared as a whole, so
a stretch of one-to-one tokens is jumped in logarithmically many comparisons;
where a block differs it is halved down to the first difference. The irregular
group there is resolved by stepping on whichever side ends earlier, which gives
the new shift.

1. ``packed`` tokenizes and aligns every text; its result is stored (``align``:
   the same as lists).
2. ``pair_counts``: in how many documents each pair of ids stands in one group.
   Tasks add up their own documents first.
3. ``report`` walks the stored groups once more and sums counts over links.
   Pairs that hold at least a HEAVY_PAIRS-th of all occurrences are at most
   HEAVY_PAIRS and are sent to all tasks; every other pair is so rare that a
   join by pair has no hot key.

Links of a group are formed in chunks of LINKS; a group with more is folded to
its distinct ids first.

A text is tokenized whole in one task: about 70 bytes of memory a byte of text
at peak; texts above PART_BYTES are handled alone.

Defined results: null and empty texts, and those whose tokens do not give the
bytes back (as of a text that holds U+2581), have no tokens and no groups; a
null doc_id is kept; repeated rows return once each and count as documents of
their own; empty tables return no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices, stored

HEAVY_PAIRS = 1 << 20
PART_BYTES = 1 << 19  # text tokenized at a time
LINKS = 1 << 18  # links formed at a time
TASK_PAIRS = 1 << 19  # pairs a task adds up before it hands them on
ROWS = 256  # stored alignments handled at a time
# Fixed value: how the byte-level vocabulary's texts are split before merging
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PACKED = "row long, doc_id long, a binary, b binary, last_a binary, last_b binary"
ALIGNED = "row long, doc_id long, a array<int>, b array<int>, group_a array<int>, group_b array<int>"
SUMS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, rest array<struct<pair:bigint,n:bigint>>"


def _file(path: str | None, name: str) -> bytes:
    """A tokenizer's file; read by the driver and sent to the tasks (1.6 MB at most)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the rest for U+0100 on."""
    itself = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in itself]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Ids and bytes of both tokenizers' tokens.

    The byte-level vocabulary is merged by tiktoken, three times as fast as the
    library of the file's format and without its offsets; ids are the order of
    merges there, which is checked, and both split texts by SPLIT (compared on
    every code point: no difference).
    """

    def __init__(self, bpe: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        model, letters = json.loads(bpe)["model"], _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if sorted(ranks.values()) != list(range(len(ranks))) or any(model["vocab"][x + y] != 256 + i for i, (x, y) in enumerate(merges)):
            raise ValueError("the ids of this vocabulary are not the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})  # none: their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = sorted(ranks, key=ranks.__getitem__)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.kind = np.uint16 if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else np.uint32
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text by both; two empty arrays where the bytes are not the text's."""
        if text:
            a, b, said = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1), (" " + text).encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == said and b"".join(map(self.bytes_b.__getitem__, b)) == said:
                return np.array(a, np.int32), np.array(b, np.int32)
        return np.zeros(0, np.int32), np.zeros(0, np.int32)


def aligned(ends_a: array, ends_b: array) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side stand before each common end; the arrays (same last entry) rise strictly."""
    n, i, j = len(ends_a), 0, 0
    at_a, at_b, run = [], [], []  # stretches: their last cut and how many cuts, one by one
    while i < n:
        start, length = i, 1
        while ends_a[i:i + length] == ends_b[j:j + length]:
            i, j, length = i + length, j + length, 2 * length
            if i >= n:
                break
        while length > 1 and i < n:
            length //= 2
            if ends_a[i:i + length] == ends_b[j:j + length]:
                i, j = i + length, j + length
        if i > n:  # both ended within the last block
            i, j = n, j - (i - n)
        if i > start:
            at_a.append(i)
            at_b.append(j)
            run.append(i - start)
        if i < n:
            x, y = ends_a[i], ends_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            i, j = i + 1, j + 1
            at_a.append(i)
            at_b.append(j)
            run.append(1)
    run = np.array(run, np.int64)
    back = np.repeat(np.cumsum(run), run) - np.arange(run.sum()) - 1
    return np.repeat(np.array(at_a, np.int64), run) - back, np.repeat(np.array(at_b, np.int64), run) - back


_LOADED: dict[str, Tokenizers] = {}


def _tokenizers(key: str, shared) -> Tokenizers:
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(*shared.value)
    return _LOADED[key]


def _loaded(bpe_path: str | None, pieces_path: str | None) -> Tokenizers:
    return Tokenizers(_file(bpe_path, "byte_bpe_50k.json"), _file(pieces_path, "piece_bpe_32k.model"))


def packed(docs: DataFrame, bpe_path: str | None = None, pieces_path: str | None = None) -> DataFrame:
    """row (a number of its own), doc_id, the ids a and b (16 bits each, 32 for a larger vocabulary) and a bit for each token that ends a group."""
    shared = docs.sparkSession.sparkContext.broadcast((_file(bpe_path, "byte_bpe_50k.json"), _file(pieces_path, "piece_bpe_32k.model")))
    key = uuid.uuid4().hex

    def run(batches):
        t = _tokenizers(key, shared)
        for batch in slices(batches, size=PART_BYTES):
            cells = []
            for a, b in map(t.encode, column(batch, "text").to_pylist()):
                cuts = aligned(*(array("q", np.cumsum(size[x]).tobytes()) for size, x in ((t.size_a, a), (t.size_b, b))))
                bits = [np.zeros(len(x), bool) for x in (a, b)]
                for bit, at in zip(bits, cuts, strict=True):
                    bit[at - 1] = True
                cells.append((a.astype(t.kind).tobytes(), b.astype(t.kind).tobytes(), *(np.packbits(bit).tobytes() for bit in bits)))
            yield pa.RecordBatch.from_arrays([column(batch, "row"), column(batch, "doc_id"), *(pa.array(c, pa.binary()) for c in zip(*cells, strict=True))],
                                             names=[c.split()[0] for c in PACKED.split(", ")])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED)


def _cells(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each cell begins (and the last ends)."""
    at = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset:cells.offset + len(cells) + 1].astype(np.int64)
    raw = cells.buffers()[2]
    return np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8), at - at[0]


def _side(part: pa.RecordBatch, side: str, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one tokenizer: ids, where each row's begin, the row and the number of tokens of each group."""
    data, at = _cells(column(part, side))
    ids, at = data.copy().view(kind).astype(np.int64), at // kind().itemsize
    bits, begin = _cells(column(part, f"last_{side}"))
    count = np.diff(at)
    last = np.unpackbits(bits)[np.arange(len(ids)) + np.repeat(8 * begin[:-1] - at[:-1], count)]
    ends = np.flatnonzero(last) + 1
    return ids, at, np.searchsorted(at, ends, "left") - 1, np.diff(ends, prepend=0)


def _blocks(batches, kind: type) -> Iterator[tuple[pa.RecordBatch, tuple, list[np.ndarray]]]:
    """Parts of packed alignments of bounded size (or one row), the flat arrays of their groups, and where each row's tokens and groups begin."""
    for batch in batches:
        ends, lo = np.cumsum(pc.binary_length(column(batch, "a")).to_numpy(zero_copy_only=False) // kind().itemsize), 0
        while lo < len(ends):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, min(lo + ROWS, int(np.searchsorted(ends, base + LINKS, "right"))))
            part = batch.slice(lo, hi - lo)
            a, at_a, row, in_a = _side(part, "a", kind)
            b, at_b, _, in_b = _side(part, "b", kind)
            yield part, (row, a, b, in_a, in_b), [at_a, at_b, np.searchsorted(row, np.arange(hi - lo + 1))]
            lo = hi


def align(docs: DataFrame, bpe_path: str | None = None, pieces_path: str | None = None) -> DataFrame:
    """row (a number of its own), doc_id, the ids a and b, and how many a and b tokens each group has."""
    kind = _loaded(bpe_path, pieces_path).kind

    def run(batches):
        for part, (_, a, b, in_a, in_b), (at_a, at_b, at) in _blocks(batches, kind):
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32()))
                     for ends, x in ((at_a, a), (at_b, b), (at, in_a), (at, in_b))]
            yield pa.RecordBatch.from_arrays([column(part, "row"), column(part, "doc_id"), *lists], names=[c.split()[0] for c in ALIGNED.split(", ")])

    return packed(docs, bpe_path, pieces_path).mapInArrow(run, ALIGNED)


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *n])
    key, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, n)
    return key, total


def links(row: np.ndarray, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, links) of the distinct id pairs of every row, sorted; row is that of each group, a pair a * wide + b."""
    from_a, from_b, size = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b, in_a * in_b
    top = (int(a.max(initial=0)) + 1) * wide
    keys, counts = [], []

    def add(key: np.ndarray, n: np.ndarray) -> None:
        keys.append(key)
        counts.append(n)
        if len(keys) > 8:
            keys[:], counts[:] = ([x] for x in _summed(keys, counts))

    for g in np.flatnonzero(size > LINKS):
        own_a, n_a = np.unique(a[from_a[g]:from_a[g] + in_a[g]], return_counts=True)
        own_b, n_b = np.unique(b[from_b[g]:from_b[g] + in_b[g]], return_counts=True)
        step = max(1, LINKS // len(own_b))
        for lo in range(0, len(own_a), step):
            add((row[g] * top + own_a[lo:lo + step, None].astype(np.int64) * wide + own_b).ravel(), (n_a[lo:lo + step, None] * n_b).ravel())
    small = np.flatnonzero(size <= LINKS)
    block = np.cumsum(size[small]) // LINKS
    for at in np.split(small, np.flatnonzero(np.diff(block)) + 1):
        n = size[at]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide_b = np.repeat(in_b[at], n)
        key = np.repeat(row[at] * top, n) + a[np.repeat(from_a[at], n) + k // wide_b].astype(np.int64) * wide + b[np.repeat(from_b[at], n) + k % wide_b]
        add(*np.unique(key, return_counts=True))
    key, n = _summed(keys, counts)
    return key // top, key % top, n


def pair_counts(alignments: DataFrame, wide: int, kind: type) -> DataFrame:
    """pair and docs, the number of rows that hold it linked."""
    def run(batches):
        def out(held):
            pair, docs = _summed(*map(list, zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(docs)], names=["pair", "docs"])

        held, size = [], 0
        for _, flat, _ in _blocks(batches, kind):
            held.append(np.unique(links(*flat, wide)[1], return_counts=True))
            size += len(held[-1][0])
            if size > TASK_PAIRS:
                merged = out(held)
                held, size = [(merged.column(0).to_numpy(), merged.column(1).to_numpy())], merged.num_rows
                if size > TASK_PAIRS // 2:
                    yield merged
                    held, size = [], 0
        if held:
            yield out(held)

    return alignments.select("a", "b", "last_a", "last_b").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _written(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, marks: list[bytes]) -> str:
    """Digest of the groups as text, a1,a2|b1;a3|b2,b3; marks: each id before a comma, then a bar, then a semicolon."""
    if not len(in_a):
        return ""
    last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)
    size = len(marks) // 3
    out = np.empty(len(a) + len(b), np.int64)
    out[place_a], out[place_b] = a, b
    out[place_a[last_a]] += size
    out[place_b[last_b]] += 2 * size
    return hashlib.sha256(b"".join(map(marks.__getitem__, out.tolist()))[:-1]).hexdigest()


def _totals(alignments: DataFrame, heavy: tuple, wide: int, names: int, kind: type) -> DataFrame:
    """Per row the figures over heavy pairs, and the other pairs with their links."""
    shared = alignments.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        pairs, docs, best = shared.value
        marks = [f"{i}{mark}".encode() for mark in ",|;" for i in range(names)]
        for part, flat, at in _blocks(batches, kind):
            n = part.num_rows
            row, pair, links_ = links(*flat, wide)
            place = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            known = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums, bests, total = (np.zeros(n, np.int64) for _ in range(3))
            np.add.at(sums, row[known], links_[known] * docs[place[known]])
            np.add.at(bests, row[known], links_[known] * best[place[known]])
            np.add.at(total, row, links_)
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[~known], np.arange(n + 1)), pa.int32()),
                                            pa.StructArray.from_arrays([pa.array(pair[~known]), pa.array(links_[~known])], ["pair", "n"]))
            _, a, b, in_a, in_b = flat
            digest = [_written(a[x:x2], b[y:y2], in_a[z:z2], in_b[z:z2], marks) for x, x2, y, y2, z, z2 in zip(*(c for x in at for c in (x, x[1:])), strict=False)]
            size = [pa.array(np.diff(x), pa.int64()) for x in at]
            yield pa.RecordBatch.from_arrays(
                [column(part, "row"), column(part, "doc_id"), *size, pa.array(total), pa.array(bests), pa.array(sums), pa.array(digest, pa.string()), rest],
                names=[c.split()[0] for c in SUMS.split(", ")])

    return alignments.mapInArrow(run, SUMS)


def report(docs: DataFrame, bpe_path: str | None = None, pieces_path: str | None = None, heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """Tokens, groups, links, links of highest count, sum of counts and a digest of the groups, per document."""
    found = _loaded(bpe_path, pieces_path)
    wide, names = len(found.bytes_b), max(len(found.bytes_a), len(found.bytes_b))
    alignments = stored(packed(docs, bpe_path, pieces_path), "alignments")
    counts = stored(pair_counts(alignments, wide, found.kind), "pairs")
    first = F.expr(f"pair div {wide}")
    tops = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("top"))  # at most one row an id
    counts = stored(counts.withColumn("a", first).join(F.broadcast(tops), "a").select(
        "pair", "docs", (F.col("docs") == F.col("top")).alias("best")), "counts")
    bar = -(-(counts.agg(F.sum("docs")).first()[0] or 0) // heavy_pairs)
    heavy = counts.where(F.col("docs") >= bar).toArrow().sort_by("pair")  # at most heavy_pairs rows
    light = counts.where(F.col("docs") < bar)
    sent = (heavy["pair"].to_numpy(), heavy["docs"].to_numpy(), heavy["best"].to_numpy())
    rows = stored(_totals(alignments, sent, wide, names, found.kind), "totals")
    more = rows.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.n").join(light, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("docs")).alias("more_sum"))
    return rows.join(more.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
