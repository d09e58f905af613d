"""Near-duplicate components by one-permutation MinHash (operator 9).

Every document's set of word shingles is hashed once; the hash's top bits pick
a bin and each bin keeps its least hash. Empty bins borrow from full ones by a
hash of (bin, attempt) (optimal densification). Bins are read in bands; equal
bands put documents into a bucket.

Documents of equal sets are collapsed first, so a group of copies is one
candidate. In a bucket only star edges are formed, from its smallest document
(the hub) to each member, and confirmed on the full sets; components follow.
A star misses links between two members. Both have the bucket's hub, so all
members of a hub that are not yet in one component are compared once more:
a hub's members are dealt into blocks of bounded number and bytes, a task gets
two blocks, and reports links between different components only. No pair of rows is ever emitted for
two documents that are not linked, and hubs whose members are connected (the
usual group of near copies) are done without it.

Chance of a missed pair of similarity 0.8: (1 - 0.8**4)**32, about 5e-8.

Defined results: null, empty or word-free texts have an empty set and are
linked with nothing; a null doc_id is kept as its own component (null) and
links nothing; rows that share a doc_id share a component, each of their texts
is compared with the others' texts; empty tables return no rows; other columns
are ignored. Texts of any length are compared whole, at about 64 bytes of
memory a byte of text; texts are handled SLICE_BYTES at a time, a longer one
alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import SLICE_BYTES, column, slices, stored
from clickmart.llm.words import U, Words, mix, spans_names

BINS = 128  # a power of two
ROWS = 4  # bins in a band
BLOCK_DOCS = 512  # members of a hub in a block
BLOCK_BYTES = 1 << 20  # and bytes of their texts
EMPTY = U(0xFFFFFFFFFFFFFFFF)
SIGNATURE = "doc_id long, hash long, n_shingles long, set1 long, set2 long, bands array<long>"


@dataclass(frozen=True)
class Similarity:
    shingle_words: int = 5
    percent: int = 80  # linked if 100 * intersection >= percent * union


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, name) of the distinct shingles of every text, sorted by row and name."""
    words = Words(texts, fold=True)
    names = words.names()
    at = words.windows(size)
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    begin = np.concatenate([at, words.first[short]])
    end = np.concatenate([at + size, words.first[short + 1]])
    row = np.concatenate([words.doc[at], short])
    name = spans_names(names, begin, end)
    order = np.lexsort((name, row))
    row, name = row[order], name[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (name[1:] != name[:-1])
    return row[new], name[new]


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    """For each attempt, the bin that each empty bin turns to; the last attempts walk through all bins."""
    tries = np.arange(4 * BINS, dtype=U)[:, None] * U(BINS) + np.arange(BINS, dtype=U)
    walk = (np.arange(BINS)[:, None] + np.arange(BINS)) % BINS
    return np.concatenate([(mix(tries + U(1)) % U(BINS)).astype(np.int64), walk])


def signatures(row: np.ndarray, name: np.ndarray, n: int) -> np.ndarray:
    """n x BINS densified one-permutation signatures of rows with a shingle; row and name as from shingle_sets."""
    shift = U(64 - (BINS.bit_length() - 1))
    cell = row * BINS + (name >> shift).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    own = np.full(n * BINS, EMPTY)
    own[cell[first]] = name[first]
    own = own.reshape(n, BINS)
    full = own != EMPTY
    out = own.copy()
    at, bin_ = np.nonzero(~full & full.any(1)[:, None])
    for donors in _donors():
        if not len(at):
            break
        donor = donors[bin_]
        ok = full[at, donor]
        out[at[ok], bin_[ok]] = own[at[ok], donor[ok]]
        at, bin_ = at[~ok], bin_[~ok]
    return out


def sign(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """doc_id, hash of the text, set size, a 128-bit name of the set, and the bucket keys of every document."""
    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            row, name = shingle_sets(column(batch, "text"), similarity.shingle_words)
            size = np.bincount(row, minlength=n)
            ends = np.cumsum(size)
            sums = [np.concatenate([np.zeros(1, U), np.cumsum(mix(name + U(k)), dtype=U)]) for k in (11, 12)]
            sets = [mix(s[ends] - s[ends - size] + size.astype(U)) for s in sums]
            bins = signatures(row, name, n)
            band = np.repeat(np.arange(BINS // ROWS, dtype=U)[None, :], n, 0)
            for k in range(ROWS):
                band = mix(band * U(31) + mix(bins[:, k::ROWS] + U(k)))
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, band.shape[1], 0))]), pa.int32()),
                                            pa.array(band[size > 0].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "hash"), pa.array(size, pa.int64()), *(pa.array(s.view(np.int64)) for s in sets), keys],
                names=[c.split()[0] for c in SIGNATURE.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").mapInArrow(run, SIGNATURE)


def components(links: DataFrame) -> DataFrame:
    """doc_id and comp, the least doc_id it is connected with, for every end of the links (a, b)."""
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("doc_id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("doc_id")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "doc_id").select("doc_id", F.col("comp").alias("before"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("doc_id").alias("comp"), F.col("comp").alias("further"))
        new = stored(step.join(jump, "comp", "left").select(
            "doc_id", "before", F.least("comp", "further").alias("comp")), "labels")
        if not new.where("comp <> before").take(1):
            return new.select("doc_id", "comp")
        labels = new.select("doc_id", "comp")


def _common(p: np.ndarray, q: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(p) > len(q):
        p, q = q, p
    return int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(q) else 0


def _pair_slices(batches):
    """Batches of pairs cut so that each holds at most SLICE_BYTES of text (or one pair)."""
    for batch in batches:
        size = sum(np.asarray(pc.fill_null(pc.binary_length(column(batch, c)), 0), np.int64) for c in ("ta", "tb"))
        ends, lo = np.cumsum(size), 0
        while lo < len(ends):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def confirm(edges: DataFrame, texts: DataFrame, similarity: Similarity) -> DataFrame:
    """a, b, common and total (of the full shingle sets) of every edge."""
    def run(batches):
        for batch in _pair_slices(batches):
            n = batch.num_rows
            both = pa.concat_arrays([column(batch, "ta"), column(batch, "tb")]).dictionary_encode()
            row, name = shingle_sets(both.dictionary, similarity.shingle_words)
            at = np.searchsorted(row, np.arange(len(both.dictionary) + 1))
            own = [name[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
            which = both.indices.to_numpy()
            common = np.array([_common(own[x], own[y]) for x, y in zip(which[:n], which[n:], strict=True)], np.int64)
            total = np.diff(at)[which[:n]] + np.diff(at)[which[n:]] - common
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), pa.array(common), pa.array(total)],
                                             names=["a", "b", "common", "total"])

    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))
    return edges.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb").mapInArrow(
        run, "a long, b long, common long, total long")


def compare_members(members: DataFrame, similarity: Similarity) -> DataFrame:
    """Links (a, b) across components among the members (hub, node, comp, text) of each hub."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int")
    sizes = members.groupBy("hub").agg(blocks.alias("blocks"))
    rows = members.join(sizes, "hub").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.struct("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).alias("block"),
        "node", "comp", "text")  # one column: a shuffle by hub alone would bring a hub's blocks together again

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, comp = pdf["node"].to_numpy(), pdf["comp"].to_numpy()
        kinds, which, n = np.unique(comp, return_inverse=True, return_counts=True)
        found = []
        if len(kinds) > 1:
            row, name = shingle_sets(pa.array(pdf["text"], pa.string()), similarity.shingle_words)
            ids = np.unique(name, return_inverse=True)[1]
            at = np.searchsorted(row, np.arange(len(doc)))
            size = np.bincount(row, minlength=len(doc))
            mark = np.zeros(len(name), np.int32)
            for x in np.flatnonzero(which != np.argmax(n)):
                own = ids[at[x]:at[x] + size[x]]
                mark[own] = 1
                common = np.add.reduceat(mark[ids], at)
                mark[own] = 0
                linked = (100 * common >= similarity.percent * (size + size[x] - common)) & (comp != comp[x])
                other = np.flatnonzero(linked)
                found += [(doc[x], doc[y]) for y in other[np.unique(comp[other], return_index=True)[1]]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("block").applyInPandas(compare, "a long, b long")


def find_links(nodes: DataFrame, docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Confirmed links (a, b) that connect all near duplicates; nodes: one row (node, doc_id, hash, bands) per set."""
    rows = nodes.select("node", F.explode("bands").alias("key"))
    hubs = stored(rows.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub"), "hubs")
    edges = stored(rows.join(hubs, "key").where("node <> hub").select(
        F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "edges")
    ids = nodes.select("node", "doc_id", "hash").join(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").join(ids, ["doc_id", "hash"])
    texts = stored(texts.dropDuplicates(["node"]).select("node", "text"), "texts")
    links = stored(confirm(edges, texts, similarity).where(
        100 * F.col("common") >= similarity.percent * F.col("total")).select("a", "b"), "confirmed")
    labels = components(links).select(F.col("doc_id").alias("d"), "comp")
    members = stored(edges.select(F.col("a").alias("hub"), F.col("b").alias("node")).join(
        labels, F.col("node") == F.col("d"), "left").select("hub", "node", F.coalesce("comp", "node").alias("comp")), "members")
    apart = stored(members.groupBy("hub").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where(
        "low <> high").select("hub"), "apart")
    members = stored(members.join(apart, "hub").join(texts, "node"), "members")
    return links.union(stored(compare_members(members, similarity), "more"))


def near_duplicates(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    signed = stored(sign(docs, similarity), "signatures")
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set1", "set2").agg(F.min("doc_id").alias("first"))
    sets = stored(sets, "sets")
    one = signed.where("n_shingles > 0").join(
        sets.select(F.col("first").alias("doc_id"), "set1", "set2"), ["doc_id", "set1", "set2"], "left_semi")
    nodes = stored(one.dropDuplicates(["doc_id", "set1", "set2"]).select(
        F.monotonically_increasing_id().alias("node"), "doc_id", "hash", "bands"), "nodes")
    links = stored(find_links(nodes, docs, similarity), "links")
    named = lambda x: nodes.select(F.col("node").alias(x), F.col("doc_id").alias(f"doc_{x}"))
    links = links.join(named("a"), "a").join(named("b"), "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    copies = signed.where("n_shingles > 0").join(sets, ["set1", "set2"]).where("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b"))
    comps = components(links.union(copies)).withColumnRenamed("doc_id", "d")
    return signed.join(comps, F.col("doc_id") == F.col("d"), "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"),
        F.coalesce(F.col("comp") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """The documents without all but one (the smallest doc_id) of each component; other rows and columns unchanged."""
    gone = near_duplicates(docs, similarity).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
