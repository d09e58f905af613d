"""SentencePiece encoding and decoding by shared-prefix forward search (operator 10).

The model is of the BPE kind, so its encoding of a text is the one path whose
neighbouring pieces are stable: merging the two pieces' characters alone gives
the two pieces back. That makes encoding a Viterbi pass with one survivor a
position: the last piece of every prefix of a word follows from the last
pieces of its shorter prefixes. Words are marked (blank to U+2581); a task
sorts the distinct new words of its rows, which puts them in the order of a
depth-first walk of their trie, and keeps the forward states of the prefix
that a word shares with the one before. Documents are then the words' pieces
in a row. No shuffle is needed; words met before stay in a cache of bounded size.

Decoding joins the pieces (byte pieces as bytes), reads UTF-8 and turns marks
into blanks again.

Defined results: a null text has null ids, an empty one no pieces; unknown
characters become byte pieces; a text that holds U+2581 itself decodes to a
blank there (round_trip is false); repeated rows return once each; an empty
table returns no rows; very long texts are encoded whole, alone if above
SLICE_BYTES; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, slices

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
TAIL = re.compile(r"(?<=[^\W_])\W+$")
CACHE_WORDS = 600_000
CACHE_PAIRS = 2_000_000
CACHE_CHARS = 20_000_000  # a text without blanks is one word
REPORT = "doc_id long, n_words long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean"


def model_bytes(path: str | None = None) -> bytes:
    """The model file; read by the driver and sent to the tasks (half a megabyte)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Pieces of a BPE model with byte fallback, and the cached pieces of words."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        skip = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not skip[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece of this model spans words")
        self.byte = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.raw = [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else b"" if skip[i] else p.encode()
                    for i, p in enumerate(self.pieces)]
        self.longest = max(map(len, self.ids))
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}
        self.after: dict[str, dict[str, bool]] = {p: {} for p in self.ids}  # piece: may it follow that piece?
        self.joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}  # neighbours inside some piece
        self.words: dict[str, bytes] = {}
        self.held = 0  # characters of the words, at least
        self.pairs = 0  # neighbours whose answer is kept

    def merged(self, text: str) -> list[str]:
        """The model's merges, best score first and leftmost, on a short string."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1)))
            if best[0] == -np.inf:
                break
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        """May piece b stand after piece a (or first, if a is empty)?"""
        if self.pairs > CACHE_PAIRS:
            for known in self.after.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        self.after[b][a] = found = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def forget(self) -> None:
        """Release the cached words at the end of a task: the worker may go on with other work."""
        self.words.clear()
        self.held = 0

    def unknown(self, char: str) -> bytes:
        return np.array([self.byte[b] for b in char.encode("utf-8", "replace")], "<i4").tobytes()

    def forward(self, word: str, last: list[str], ids: list[bytes], start: int) -> None:
        """Fills last[i], the last piece of word[:i], and ids[i], that piece packed, for i over ``start``."""
        del last[start + 1:], ids[start + 1:]
        after = self.after
        for i in range(start + 1, len(word) + 1):
            for k in range(i - 1, max(-1, i - 1 - self.longest), -1):
                piece = word[k:i]
                known = after.get(piece)
                if known is None:
                    continue
                fits = known.get(last[k])
                if fits or fits is None and self.follows(last[k], piece):
                    last.append(piece)
                    ids.append(self.packed[piece])
                    break
            else:
                last.append(word[i - 1])
                ids.append(self.unknown(word[i - 1]))

    @staticmethod
    def path(last: list[str], ids: list[bytes]) -> bytes:
        """The packed pieces of the whole word, walked back from its end."""
        found, i = [], len(last) - 1
        while i:
            found.append(ids[i])
            i -= len(last[i])
        return b"".join(reversed(found))

    def learn(self, words: set[str]) -> None:
        """Adds the pieces of new words, in trie order.

        Closing punctuation is cut off first where no piece can span the cut.
        """
        if len(self.words) > CACHE_WORDS or self.held > CACHE_CHARS:
            self.words.clear()
            self.held = 0
        new, cuts = words - self.words.keys(), {}
        for word in new:
            if not word[-1].isalnum() and (m := TAIL.search(word)) and word[m.start() - 1:m.start() + 1] not in self.joined:
                cuts[word] = m.start()
        heads = new.difference(cuts) | {w[:c] for w, c in cuts.items()} | {w[c:] for w, c in cuts.items()}
        self.held += sum(map(len, new)) + sum(map(len, heads))
        last, ids, before = [""], [b""], ""
        for word in sorted(heads - self.words.keys()):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            self.forward(word, last, ids, shared)
            self.words[word] = self.path(last, ids)
            before = word
        for word, c in cuts.items():
            self.words[word] = self.words[word[:c]] + self.words[word[c:]]

    def split(self, text: str) -> list[str]:
        return WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text

    def encode_all(self, texts: list[str | None]):
        """(words, packed ids) of each text."""
        split = [None if t is None else self.split(t) for t in texts]
        self.learn({w for ws in split if ws for w in ws})
        return [(0, None) if ws is None else (len(ws), b"".join(map(self.words.__getitem__, ws))) for ws in split]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def _shared(df: DataFrame, path: str | None):
    return uuid.uuid4().hex, df.sparkSession.sparkContext.broadcast(model_bytes(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    key, shared = _shared(docs, path)

    def run(batches):
        encoder = _encoder(key, shared)
        try:
            for batch in slices(batches):
                ids = [None if p is None else np.frombuffer(p, "<i4") for _, p in encoder.encode_all(column(batch, "text").to_pylist())]
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
        finally:
            encoder.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""
    key, shared = _shared(tokens, path)

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Counts, a digest of the ids (little-endian 32-bit) and whether they decode to the text, per document."""
    key, shared = _shared(docs, path)

    def run(batches):
        encoder = _encoder(key, shared)
        low, high = min(encoder.byte.values()), max(encoder.byte.values())
        try:
            for batch in slices(batches):
                texts, rows = column(batch, "text").to_pylist(), []
                for text, (n, packed) in zip(texts, encoder.encode_all(texts), strict=True):
                    ids = np.frombuffer(packed or b"", "<i4")
                    rows.append((n, len(ids), int(((ids >= low) & (ids <= high)).sum()),
                                 None if packed is None else hashlib.sha256(packed).hexdigest(),
                                 text is None or encoder.decode(ids.tolist()) == text))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id"), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 3 + (pa.string(), pa.bool_()), strict=True))],
                    names=[c.split()[0] for c in REPORT.split(", ")])
        finally:
            encoder.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, REPORT)
