"""WARC archives with revisit records and boundary-chain verification (operator 2).

Writing: each task writes one archive through Spark's text writer, whose line
separator is the record terminator, so commits and lost executors are handled
by Spark. A payload of MIN_REVISIT_BYTES or more is stored once (smallest
page_id); its equals become revisit records that hold no payload.

Reading: tasks scan byte ranges of the archives and emit each place that looks
like a record with the offset of its successor. Payloads may hold the magic
string too, so a candidate counts only if it can be reached from its file's
start. Inside a range, chains are followed by the task; across ranges, pointer
jumping doubles the steps each round, so rounds grow as the logarithm of the
ranges in a file. A chain that does not end at the end of its file raises. A
task takes many ranges, one after the other.

Archives of others are read too: versions 1.0 and 1.1, records of any type,
without this module's own fields. Files that end in ``.gz`` (a gzip member a
record) are inflated member by member from a file handle, one task a file: a
member's end is known only by inflating it.

Defined results: null html is an empty payload; a null url has no target URI;
control characters, blanks and percent signs of a url are percent-encoded; a
null page_id stays null and is never the first of its payload unless no other
is there; rows that repeat the smallest page_id with its payload are all
responses; an empty table gives no records; other columns are ignored. Records
without a field have null there; a payload is compared with its digest where
that is a SHA-256 in hex. A record is held whole in its task (about twice its
bytes), so a payload must fit there; a row of Spark holds at most 2 GB.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm.common import stored, without_shuffle_files

MAGIC = b"WARC/1.0\r\n"
START = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 100
RANGE_BYTES = 4 << 20
TASKS_PER_CORE = 8  # at most
HEAD_BYTES = 64 << 10  # read beyond a range for the header of its last record
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FRAME_ROWS = 4096
RECORD = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "target_uri string, file string, offset long")


def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("null"))))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, bytes, first: the page that holds the payload (null: this one does)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("bytes"))
    again = rows.where(F.col("bytes") >= MIN_REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    joined = rows.join(again, "digest", "left")
    return joined.withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))


def write_archives(pages: DataFrame, path: str) -> None:
    r = records(pages)
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    uri = F.col("url")
    for c in ["%", *map(chr, range(33)), "\x7f"]:
        uri = F.replace(uri, F.lit(c), F.lit(f"%{ord(c):02X}"))
    uri = F.when(F.col("url").rlike(r"[\x00-\x20%\x7F]"), uri).otherwise(F.col("url"))
    head = F.concat(
        F.lit(MAGIC.decode()), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", uri), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("X-Payload-Length", F.col("bytes").cast("string")), _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))),
        _line("X-Refers-To-Page-ID", F.col("first").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    with without_shuffle_files(pages.sparkSession):
        r.select(F.concat(head, block).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def _open(uri: str):
    uri = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", uri))
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _header(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Fields of the record at ``at`` and where its block starts; None if it is no record."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0 or not START.match(data, at):
        return None
    fields = {}
    for line in data[at + len(MAGIC):end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def _scan(file: str, start: int, size: int) -> list[tuple[int, int, int]]:
    """(offset, successor, first offset of its chain at or beyond this range) of each candidate in the range."""
    with _open(file) as f:
        length = f.size()
        data = f.read_at(min(size + HEAD_BYTES, length - start), start)
        found, at = {}, 0
        while (m := START.search(data, at)) and m.start() < size:
            at = m.start()
            head = _header(data, at)
            while head is None and start + len(data) < length and b"\r\n\r\n" not in data[at:]:
                data += f.read_at(min(len(data), length - start - len(data)), start + len(data))
                head = _header(data, at)
            if head and (following := start + head[1] + int(head[0]["content-length"]) + 4) <= length:
                found[start + at] = following
            at += 1
    leaves = {}
    for at in sorted(found, reverse=True):
        leaves[at] = leaves.get(found[at], found[at])
    return [(at, found[at], leaves[at]) for at in found]


def _tasks(df: DataFrame, n: int) -> DataFrame:
    """``df`` (n rows, named by the first two columns) over no more tasks than the cluster runs in TASKS_PER_CORE waves."""
    most = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(n, most)), *df.columns[:2])


def candidates(ranges: DataFrame, n: int) -> DataFrame:
    def scan(frames):
        for pdf in frames:
            for file, start, size, length in pdf.itertuples(index=False):
                yield pd.DataFrame([(file, start, length, *x) for x in _scan(file, start, size)],
                                   columns=["file", "start", "length", "offset", "successor", "leaves"])

    return _tasks(ranges, n).mapInPandas(scan, "file string, start long, length long, offset long, successor long, leaves long")


def entries(found: DataFrame) -> DataFrame:
    """Of the candidates, where the true chain enters each range (by pointer jumping from offset 0)."""
    jump = found.select("file", "offset", F.col("leaves").alias("to"))
    reached = found.where("offset = 0").select("file", "offset")
    total = reached.count()
    while True:
        onward = reached.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        onward = onward.join(found.select("file", "offset"), ["file", "offset"], "left_semi")
        reached = stored(reached.union(onward).distinct(), "reached")
        before, total = total, reached.count()
        if total == before:
            return reached
        second = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("second"))
        jump = stored(jump.join(second, ["file", "to"], "left").select(
            "file", "offset", F.coalesce("second", "to").alias("to")), "jump")


def _record(fields: dict[str, str], block: bytes, file: str, at: int) -> tuple:
    kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    own = re.fullmatch("sha256:([0-9a-f]{64})", said)
    if kind == "revisit":
        length = fields.get("x-payload-length")
        size, digest = length and int(length), own and own[1]
    elif own and digest != own[1]:
        raise ValueError(f"{file}: the payload at {at} does not have its digest")
    page, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return page and int(page), kind, size, digest, first and int(first), fields.get("warc-target-uri"), file, at


def _read(file: str, start: int, stop: int) -> Iterator[tuple]:
    """The records of the chain from ``start`` up to ``stop``."""
    with _open(file) as f:
        at = start
        while at < stop:
            want = HEAD_BYTES
            while (head := _header(data := f.read_at(want, at), 0)) is None and len(data) == want:
                want *= 2
            fields, block = head
            n = int(fields["content-length"])
            yield _record(fields, data[block:block + n] if len(data) >= block + n else f.read_at(n, at + block), file, at)
            at += block + n + 4


def _inflate(file: str) -> Iterator[tuple]:
    """The records of a file with a gzip member a record; their offsets are those of the members."""
    with _open(file) as f:
        at, raw, end = 0, b"", f.size()
        while at < end:
            member, data, used = zlib.decompressobj(31), [], 0
            while not member.eof:
                raw = raw or f.read(HEAD_BYTES)
                if not raw:
                    raise ValueError(f"{file}: the member at {at} breaks off")
                data.append(member.decompress(raw))
                used += len(raw) - len(member.unused_data)
                raw = member.unused_data
            data = b"".join(data)
            head = _header(data, 0)
            if head is None or len(data) < head[1] + int(head[0]["content-length"]):
                raise ValueError(f"{file}: the member at {at} is not a record")
            yield _record(head[0], data[head[1]:head[1] + int(head[0]["content-length"])], file, at)
            at += used


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Frames of a bounded number of records."""
    while part := list(islice(rows, FRAME_ROWS)):
        yield pd.DataFrame(part, columns=[c.split()[0] for c in RECORD.split(", ")]).astype(
            {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")
    zipped = F.lower("file").endswith(".gz")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = stored(files.where(~zipped).select("file", starts.alias("start"), F.lit(range_bytes).cast("long").alias("size"), "length"), "ranges")
    n = ranges.count()
    found = stored(candidates(ranges, n), "candidates")
    reached = stored(entries(found).join(found, ["file", "offset"]).select("file", "offset", "leaves", "length"), "entries")
    ended = reached.where("leaves = length").select("file")
    broken = ranges.select("file").distinct().join(ended, "file", "left_anti").take(3)
    if broken:
        raise ValueError(f"the record chain breaks off in {[r['file'] for r in broken]}")

    def read(frames):
        for pdf in frames:
            for file, at, leaves, _ in pdf.itertuples(index=False):
                yield from _frames(_read(file, at, leaves))

    def inflate(frames):
        for pdf in frames:
            for file in pdf["file"]:
                yield from _frames(_inflate(file))

    out = _tasks(reached, n).mapInPandas(read, RECORD)
    members = files.where(zipped).select("file", "length")
    if members.take(1):
        out = out.unionByName(_tasks(members, members.count()).mapInPandas(inflate, RECORD))
    return out
