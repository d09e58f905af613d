"""Toxicity by the nearest labelled examples (operator 6).

A bounded sample of labelled rows (SAMPLE_PER_CLASS of each class, by a hash)
is the example set; labels are learned only from rows outside the held-out
fold. Terms are words and word beginnings, and every term of every example is
in the vocabulary. A term weighs its inverse document frequency, counted over
all documents, times z of its share in toxic against clean examples where that
is over 1: no term is left out, and a word too rare to be judged keeps its
plain weight. Texts become TF-IDF vectors whose length takes all their terms;
those of no example count as held by this document alone. Tasks know terms by
64-bit hashes.

Neighbours are found in a block-max inverted index. Examples stand in an order
of likeness (halved again and again by their main components), in blocks of
BLOCK_EXAMPLES.
The lists of rare terms are short and are added up whole. Of a frequent term the
index has the greatest weight in each block: with the block's best rare sum these
bound the cosine of all its examples. The blocks that are likeliest by their mean
weights are added up first; only the blocks whose bound reaches the k-th best sum
so far follow, the others are skipped.

Neighbours vote with their similarity; votes are turned into probabilities by
an isotonic fit on the sample (each example without itself, classes weighted
back to their share). The sample is bounded by a parameter, at 2 * SAMPLE_PER_CLASS
rows, so examples, vocabulary and index may pass through the driver and be sent
to all tasks; their size is that of the examples' texts (12,000 examples of
2.5 KB: about 200 MB in a task).

Defined results: null, empty and term-free texts have no neighbours and get
the share of toxic rows among such examples; without labelled rows every score
is 0; labels that are null are left out, of several for a document the largest
counts; labels of one class only give every score 0 or 1; a null doc_id is
scored and never learned from; repeated rows return once each; very long texts
are compared whole, alone if above SLICE_BYTES; empty tables return no rows;
other columns are ignored (or kept by ``remove_toxic``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices, stored
from clickmart.llm.decontaminate import FOLD

SAMPLE_PER_CLASS = 6000
BEGINNINGS = (4, 5)  # bytes
NEIGHBOURS = 15
BLOCK = 768  # texts compared at a time
FACTORS = 1 << 12  # counts whose weights are kept
GATHERED = 32  # of them put beside a block's terms at a time: what fits a core's cache
BLOCK_EXAMPLES = 64
FIRST_BLOCKS = 3  # a text's likeliest blocks, added up before others are skipped
FREQUENT = 4096  # terms, those in most examples, have greatest weights by block
PREPARED_POSTINGS = 1 << 19  # put into the index at a time
COMPONENTS = 16  # main components that order the examples,
COMPONENT_TERMS = 1024  # over those in most examples
ROUNDING = 2e-4  # bounds the error of sums of single-precision products, of the two scores compared
SMOOTH = 0.5  # similarity that votes for clean
REJECT = 0.3
PREPARED = ("lengths", "factors", "places", "impacts", "lists", "frequent", "mean", "most", "query", "asked")


class Numbers:
    """The numbers of known terms, by 64-bit hashes: 12 bytes a term in every task, where a dictionary takes over 100."""

    def __init__(self, terms: Iterable[bytes]):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)

    def __len__(self) -> int:
        return len(self.hashes)

    def of(self, terms: list[bytes]) -> np.ndarray:
        """Number of each term; unknown ones are numbered after the known."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
        order, place = np.argsort(hashes), np.empty(len(hashes), np.int64)
        place[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), max(len(self) - 1, 0))  # neighbours lie in the cache
        known = self.hashes[place] == hashes if len(self) else np.zeros(len(hashes), bool)
        out = np.empty(len(hashes), np.int64)
        out[known] = self.numbers[place[known]]
        out[~known] = len(self) + np.unique(hashes[~known], return_inverse=True)[1]
        return out


def listed(values: pa.Array) -> list[bytes]:
    return values.to_numpy(zero_copy_only=False).tolist()


def term_counts(texts: pa.Array, known: Numbers | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(row, term number, count) of the words and of the beginnings of longer words, sorted by row and term.

    Terms are numbered by ``known``, or else in the order of the returned list.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes() if len(texts) and ends[-1] > ends[0] else b""
    folded = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data.translate(FOLD))])
    split = pc.split_pattern(folded, b" ")
    words = split.flatten()
    row = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(split)))
    full = np.asarray(pc.binary_length(words)) > 0
    coded = words.filter(pa.array(full)).dictionary_encode()
    terms = listed(coded.dictionary)
    size, parts = np.asarray(pc.binary_length(coded.dictionary)), []
    for k in BEGINNINGS:  # each once
        long = np.flatnonzero(size > k)
        begins = pc.binary_slice(coded.dictionary.take(pa.array(long)), 0, k).dictionary_encode()
        parts.append((long, len(terms) + np.asarray(begins.indices)))
        terms += [w + b"*" for w in listed(begins.dictionary)]
    names = [] if known is not None else terms
    found = known.of(terms) if known is not None else np.arange(len(terms))
    numbers = np.full((len(size), 1 + len(BEGINNINGS)), -1, np.int64)
    numbers[:, 0] = found[:len(size)]
    for j, (long, at) in enumerate(parts, 1):
        numbers[long, j] = found[at]
    numbers = numbers[np.asarray(coded.indices)]
    width = max(int(found.max(initial=-1)) + 1, 1)
    key, n = np.unique((row[full][:, None] * width + numbers)[numbers >= 0], return_counts=True)
    return key // width, key % width, n, names


def spread(ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chosen lists' entries, list after list, and the lists' lengths."""
    size = ends[which + 1] - ends[which]
    return np.arange(size.sum()) + np.repeat(ends[which] - (np.cumsum(size) - size), size), size


def halves(rows: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """The rows, halved along the longest direction of their points until BLOCK_EXAMPLES at most are left; whole blocks but for the last."""
    if len(rows) <= BLOCK_EXAMPLES or not points.shape[1]:
        return [rows]
    own = points[rows] - points[rows].mean(0)
    rows = rows[np.argsort(own @ np.linalg.eigh(own.T @ own)[1][:, -1], kind="stable")]
    middle = -(-(len(rows) // 2) // BLOCK_EXAMPLES) * BLOCK_EXAMPLES
    return halves(rows[:middle], points) + halves(rows[middle:], points)


@dataclass
class Model:
    """Vocabulary, term weights, the examples' terms and counts, and the calibration; ``prepare`` adds vectors and index.

    Terms are numbered from the one in most examples to the rarest.
    """

    vocabulary: dict[bytes, int]
    weight: np.ndarray  # of the terms
    unseen: float  # weight of a term of no example
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of the examples
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # ends of the examples' vectors, after a 0
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    known: Numbers | None = None  # of the vocabulary
    order: np.ndarray | None = None  # the examples in the order of likeness
    steps: np.ndarray = field(default_factory=lambda: np.full(1, -1.0))  # calibration: raw vote
    values: np.ndarray = field(default_factory=lambda: np.zeros(1))  # and probability

    def __getstate__(self) -> dict:
        """What tasks are sent: the vectors as packed numbers and counts, without what ``prepare`` makes of them."""
        state = {k: v for k, v in self.__dict__.items() if k not in (*PREPARED, "vocabulary", "sent")}
        return state | {k: (state[k].dtype.str, zlib.compress(state[k].tobytes(), 1)) for k in ("terms", "counts")} | {"known": self.numbers()}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.vocabulary = {}  # tasks have the numbers only
        for k in ("terms", "counts"):
            setattr(self, k, np.frombuffer(zlib.decompress(state[k][1]), state[k][0]))

    def numbers(self) -> Numbers:
        if self.known is None:
            self.known = Numbers(self.vocabulary)
        return self.known

    def prepare(self) -> None:
        """Lengths of the examples' vectors, and their index by term: lists of rare terms, and of frequent ones the weights, by
        block for the terms in it, and the greatest and the mean weight in each block. Places in the index are those of ``order``, filled up
        to whole blocks."""
        if hasattr(self, "most"):
            return
        n = len(self.ids)
        if self.order is None:
            self.order = np.arange(n)
        small = np.uint16 if n <= 1 << 16 else np.int32
        self.lengths, places, weights = np.zeros(n), np.empty(len(self.terms), small), np.empty(len(self.terms), np.float32)
        self.factors = 1 + np.log(np.maximum(np.arange(FACTORS), 1))
        self.frequent = []  # by block: its frequent terms, and in terms x places their weights over 0 and where these are
        most = np.zeros((min(FREQUENT, len(self.weight)), -(-n // BLOCK_EXAMPLES)), np.float32)  # terms x blocks
        self.mean = np.zeros_like(most)
        for lo in range(0, n, BLOCK_EXAMPLES):
            block = self.order[lo:lo + BLOCK_EXAMPLES]
            at, size = spread(self.rows, block)
            place, term = np.repeat(np.arange(len(block)), size), self.terms[at]
            w = self._factor(self.counts[at]) * self.weight[term]
            self.lengths[block] = np.sqrt(np.bincount(place, w * w, len(block)))
            w /= self.lengths[block][place]
            places[at], weights[at] = lo + place, w
            often = term < FREQUENT
            held = np.zeros(len(most), bool)
            held[term[often]] = True
            terms, row = np.flatnonzero(held), (np.cumsum(held) - 1)[term[often]]
            self.frequent.append((terms, (row * BLOCK_EXAMPLES + place[often]).astype(np.int32), w[often].astype(np.float32)))
            inside = self._inside(lo // BLOCK_EXAMPLES)[1]
            most[terms, lo // BLOCK_EXAMPLES], self.mean[terms, lo // BLOCK_EXAMPLES] = inside.max(1, initial=0), inside.sum(1) / len(block)
        sizes = np.bincount(self.terms, minlength=len(self.weight))
        sizes[:FREQUENT] = 0
        self.lists = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.places, self.impacts = np.empty(self.lists[-1], small), np.empty(self.lists[-1], np.float32)
        cuts = np.searchsorted(self.lists, np.arange(0, max(1, self.lists[-1]), PREPARED_POSTINGS))
        for first, last in zip(cuts, np.append(cuts[1:], len(self.weight)), strict=True):
            own = np.flatnonzero((self.terms >= max(first, FREQUENT)) & (self.terms < last))
            own = own[np.argsort(self.terms[own])]
            to = slice(self.lists[first], self.lists[last])
            self.places[to], self.impacts[to] = places[own], weights[own]
        self.query, self.asked = np.zeros(len(self.weight)), np.zeros(len(self.weight), bool)
        self.most = most

    def _factor(self, counts: np.ndarray) -> np.ndarray:
        return self.factors.take(counts) if counts.max(initial=0) < FACTORS else 1 + np.log(counts, dtype=float)

    def _inside(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The frequent terms of a block, and their weights as terms x places."""
        terms, at, weights = self.frequent[block]
        inside = np.zeros(len(terms) * BLOCK_EXAMPLES, np.float32)
        inside[at] = weights
        return terms, inside.reshape(-1, BLOCK_EXAMPLES)

    def pack(self) -> None:
        """Order the examples by likeness, halved by their main components over the frequent terms, and keep small numbers small."""
        self.prepare()
        common = min(COMPONENT_TERMS, len(self.most))

        def inside(block: int) -> np.ndarray:
            terms, weights = self._inside(block)
            out = np.zeros((common, BLOCK_EXAMPLES), np.float32)
            out[terms[terms < common]] = weights[terms < common]
            return out

        products = sum(x @ x.T for x in map(inside, range(len(self.frequent))))
        components = np.linalg.eigh(products)[1][:, ::-1][:, :COMPONENTS]
        at = np.hstack([components.T @ inside(b) for b in range(len(self.frequent))])[:, :len(self.ids)]
        self.order = np.concatenate(halves(np.arange(len(self.ids)), at.T))
        self.terms = self.terms.astype(np.int32)
        if self.counts.max(initial=0) < 1 << 16:
            self.counts = self.counts.astype(np.uint16)
        for made in PREPARED:
            delattr(self, made)

    def own(self, example: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of an example's vector."""
        part = slice(self.rows[example], self.rows[example + 1])
        return self.terms[part], (1 + np.log(self.counts[part], dtype=float)) * self.weight[self.terms[part]] / self.lengths[example]

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of every text; all its terms count in its length, those of the examples are returned."""
        row, term, n, _ = term_counts(texts, self.numbers())
        seen = term < len(self.weight)
        w = (1 + np.log(n)) * np.append(self.weight, self.unseen)[np.minimum(term, len(self.weight))]
        w = (w / np.sqrt(np.bincount(row, w * w, len(texts)))[row])[seen]
        row, term = row[seen], term[seen]
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        return [(term[x:y], w[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors(pa.array([text], pa.string()))[0]

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, without: list[int] | None = None):
        """For each vector the k examples of highest cosine over 0, best first (ties: the earlier example).

        Sums are in single precision; the examples that rounding leaves in question are compared again in full, in double
        precision.
        """
        out: list = [[]] * len(vectors)
        if not len(self.ids) or not vectors:
            return out
        self.prepare()
        where = np.argsort(self.order) if without is not None else None
        width, common = self.most.shape[1] * BLOCK_EXAMPLES, len(self.most)
        for lo in range(0, len(vectors), BLOCK):
            some = vectors[lo:lo + BLOCK]
            often, scores = np.zeros((len(some), common), np.float32), np.empty((len(some), width), np.float32)
            cuts = [int(np.searchsorted(own, common)) for own, _ in some]
            for row, cut, (own, w) in zip(often, cuts, some, strict=True):
                row[own[:cut]] = w[:cut]
            likely = often @ self.mean
            alike = np.argsort(likely.argmax(1), kind="stable").tolist()  # texts that share lists and examples follow each other
            for i in alike:
                own, w = some[i]
                scores[i] = self._rare(own[cuts[i]:], w[cuts[i]:], width)
                if without is not None:
                    scores[i, where[without[lo + i]]] = -2.0  # below every bar
            bars = self._sum_up(scores, often, likely, k)
            for i in alike:
                row = scores[i]
                near = np.flatnonzero(row >= bars[i])
                if len(near) > k:
                    near = near[row[near] >= np.partition(row[near], -k)[-k] - ROUNDING]
                out[lo + i] = self._exact(*some[i], self.order[near], k)
        return out

    def _rare(self, own: np.ndarray, w: np.ndarray, width: int) -> np.ndarray:
        """The sums of a vector's rare terms, at every place."""
        at, size = spread(self.lists, own)
        return np.bincount(self.places.take(at), self.impacts.take(at) * np.repeat(w.astype(np.float32), size), width)

    def _sum_up(self, scores: np.ndarray, often: np.ndarray, likely: np.ndarray, k: int) -> np.ndarray:
        """Add the frequent terms' sums to those of the rare ones where a text's k best can be; returns bars that these reach."""
        blocks = scores.reshape(len(scores), -1, BLOCK_EXAMPLES)
        rare = blocks.max(2)
        bounds = rare + often @ self.most
        first = min(FIRST_BLOCKS + -(-k // BLOCK_EXAMPLES) - 1, blocks.shape[1])
        best = np.argpartition(-(likely + rare), first - 1, 1)[:, :first]
        marked = np.zeros(bounds.shape, bool)
        np.put_along_axis(marked, best, True, 1)
        self._add(scores, often, marked)
        reached = np.take_along_axis(blocks, best[:, :, None], 1).reshape(len(scores), -1)
        bars = np.maximum(np.partition(reached, -k, 1)[:, -k] if reached.shape[1] >= k else 0, ROUNDING) - ROUNDING
        bars = np.maximum(bars, np.finfo(np.float32).tiny)  # over 0
        self._add(scores, often, ~marked & (bounds >= bars[:, None]))
        return bars

    def _add(self, scores: np.ndarray, often: np.ndarray, blocks: np.ndarray) -> None:
        """Add the frequent terms' sums, of the marked blocks of each text."""
        for b in np.flatnonzero(blocks.any(0)).tolist():
            marked, (terms, weights) = np.flatnonzero(blocks[:, b]), self._inside(b)
            for lo in range(0, len(marked), GATHERED):
                texts = marked[lo:lo + GATHERED]
                scores[texts, b * BLOCK_EXAMPLES:(b + 1) * BLOCK_EXAMPLES] += often[texts].take(terms, 1) @ weights

    def _exact(self, own: np.ndarray, w: np.ndarray, kept: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best of the kept examples over 0, in double precision."""
        parts = [slice(*x) for x in zip(self.rows[kept].tolist(), self.rows[kept + 1].tolist(), strict=True)]
        if not parts:
            return []
        term = np.concatenate([self.terms[x] for x in parts])
        self.query[own], self.asked[own] = w * self.weight[own], True
        both = np.flatnonzero(self.asked.take(term))
        shared = term.take(both)
        self.asked[own] = False
        products = self._factor(np.concatenate([self.counts[x] for x in parts]).take(both)) * self.query.take(shared)
        ends = np.searchsorted(both, np.cumsum(self.rows[kept + 1] - self.rows[kept]))
        example = np.repeat(np.arange(len(kept)), np.diff(ends, prepend=0))
        exact = np.round(np.bincount(example, products, len(kept)) / self.lengths[kept], 9)
        order = np.lexsort((kept, -exact))[:k]
        return [(s, e) for s, e in zip(exact[order].tolist(), kept[order].tolist(), strict=True) if s > 0]

    def neighbours(self, own: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        return self.nearest([(own, weights)], k)[0]

    def vote(self, near: list[tuple[float, int]]) -> float:
        total = sum(s for s, _ in near)
        return sum(s * self.labels[e] for s, e in near) / (total + SMOOTH)

    def scores(self, texts: pa.Array) -> list[tuple[float, list[tuple[float, int]]]]:
        """Score and neighbours of every text."""
        near = self.nearest(self.vectors(texts))
        return [*zip(np.interp([self.vote(x) for x in near], self.steps, self.values).tolist(), near, strict=True)]


def isotonic(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the level parts of the non-decreasing fit, raw votes and probabilities; between two parts it is a straight line."""
    pools: list[list[float]] = []  # first raw, weight, weighted labels, last raw
    for x in np.unique(raw):
        own = raw == x
        pools.append([float(x), float(weight[own].sum()), float((weight * label)[own].sum()), float(x)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, w, y, last = pools.pop()
            pools[-1][3] = last
            pools[-1][1] += w
            pools[-1][2] += y
    return np.array([x for p in pools for x in (p[0], p[3])]), np.repeat([p[2] / p[1] for p in pools], 2)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, list[int]]:
    """doc_id, toxic and text of the example rows, and the number of learning rows of each class."""
    rows = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 2)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    rows = stored(rows.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    count = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    few = stored(chosen[0].union(chosen[1]), "chosen")  # at most 2 * per_class rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return stored(sample, "sample"), [count.get(0, 0), count.get(1, 0)]


def _vocabulary(sample: DataFrame, n: list[int]) -> tuple[list[bytes], np.ndarray]:
    """All terms of the examples, from the one in most examples to the rarest, and z of their share in toxic against clean ones."""
    def run(batches):
        for batch in slices(batches):
            row, term, _, names = term_counts(column(batch, "text"))
            toxic = np.bincount(term, column(batch, "toxic").to_numpy()[row], len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(np.bincount(term, minlength=len(names)) - toxic, pa.int64()),
                                              pa.array(toxic, pa.int64())], names=["term", "clean", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(run, "term binary, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = counts.orderBy(F.desc(F.col("clean") + F.col("toxic")), "term").toArrow()
    clean, toxic = found["clean"].to_numpy(), found["toxic"].to_numpy()
    share = (clean + toxic) / sum(n)
    return found["term"].to_pylist(), (toxic / n[1] - clean / n[0]) / np.sqrt(share * (1 - share + 1e-9) * (1 / n[0] + 1 / n[1]))


def _frequencies(docs: DataFrame, known: Numbers) -> tuple[int, np.ndarray]:
    """The number of documents, and of documents with each term."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        v, rows = shared.value, 0
        total = np.zeros(len(v), np.int64)
        for batch in slices(batches):
            rows += batch.num_rows
            term = term_counts(column(batch, "text"), v)[1]
            total += np.bincount(term[term < len(v)], minlength=len(v))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows), pa.int64())],
                                         names=["term", "n"])

    found = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(known))
    df[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), df


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    sample, n = _sample(docs, labels, per_class)
    if not all(n):
        return Model({}, np.zeros(0), 1.0, values=np.array([1.0 if n[1] else 0.0]))
    used = [min(x, per_class) for x in n]
    words, z = _vocabulary(sample, used)
    vocabulary = {t: i for i, t in enumerate(words)}
    known = Numbers(words)
    total, df = _frequencies(docs, known)
    model = Model(vocabulary, (np.log((1 + total) / (1 + df)) + 1) * np.maximum(z, 1), math.log((1 + total) / 2) + 1, known=known)
    context = docs.sparkSession.sparkContext
    empty = context.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            row, term, count, _ = term_counts(column(batch, "text"), empty.value.known)
            ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "toxic"), *(pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (term, count))],
                names=["doc_id", "toxic", "terms", "counts"])

    rows = sample.mapInArrow(run, "doc_id long, toxic int, terms array<int>, counts array<int>").orderBy("doc_id").toArrow()
    empty.destroy()
    del words, vocabulary, df
    model.ids, model.labels = rows["doc_id"].to_numpy(), rows["toxic"].to_numpy()
    model.rows = np.append(0, np.cumsum(pc.list_value_length(rows["terms"]).to_numpy())).astype(np.int64)
    model.terms, model.counts = pc.list_flatten(rows["terms"]).to_numpy(), pc.list_flatten(rows["counts"]).to_numpy()
    del rows
    model.pack()
    filled = context.broadcast(replace(model, vocabulary={}, known=Numbers([])))  # votes need no words

    def votes(batches):
        m = filled.value
        m.prepare()
        for batch in batches:
            at = column(batch, "id").to_pylist()
            near = m.nearest([m.own(i) for i in at], without=at)
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array([m.vote(x) for x in near], pa.float64())], names=["id", "raw"])

    raw = docs.sparkSession.range(len(model.ids)).mapInArrow(votes, "id long, raw double").toArrow().sort_by("id")["raw"].to_numpy()
    model.sent = filled
    weight = np.array(n)[model.labels] / np.array(used)[model.labels]
    model.steps, model.values = isotonic(raw, model.labels, weight)
    return model


def shared_with_tasks(spark: SparkSession, model: Model) -> Callable[[], Model]:
    """Gives tasks the model. Where it was sent for the votes, a worker has it, prepared, and gets only the words and the calibration."""
    context = spark.sparkContext
    sent = getattr(model, "sent", None) or context.broadcast(model)
    rest = context.broadcast((model.numbers(), model.steps, model.values))

    def value() -> Model:
        found = sent.value
        found.known, found.steps, found.values = rest.value
        return found

    return value


def score(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``docs`` (all columns, nested as ``row``) with score, predicted and evidence (example doc_id, similarity, label)."""
    shared = shared_with_tasks(docs.sparkSession, fit(docs if learn_from is None else learn_from, labels))
    rows = docs.select(F.struct("*").alias("row"), "text")
    out = rows.select("row", F.lit(0.0).alias("score"), F.lit(None).cast("array<struct<doc_id:bigint,similarity:double,toxic:int>>").alias("evidence"))
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        model = shared()
        for batch in slices(batches):
            found = model.scores(column(batch, "text"))
            near = [[{"doc_id": int(model.ids[e]), "similarity": s, "toxic": int(model.labels[e])} for s, e in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "row"), pa.array([s for s, _ in found], pa.float64()), pa.array(near, evidence)], names=["row", "score", "evidence"])

    return rows.mapInArrow(run, out.schema).withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = shared_with_tasks(docs.sparkSession, fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels))

    def run(batches):
        model = shared()
        for batch in slices(batches):
            found = [s for s, _ in model.scores(column(batch, "text"))]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= REJECT).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, unchanged."""
    shared = shared_with_tasks(docs.sparkSession, fit(docs, labels))

    def run(batches):
        model = shared()
        for batch in slices(batches):
            found = model.scores(column(batch, "text"))
            yield batch.filter(pa.array([s < REJECT for s, _ in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
