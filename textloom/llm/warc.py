"""Operator 10, WARC archives with a two-level capture index.

Writing: each page becomes a WARC/1.1 record, one gzip member each; of records with equal payloads of at least
`REVISIT_BYTES` bytes that with the largest id is the response and the others are revisits that name it by URI and date. Index: one
line for each record, keyed by its reversed-host URL key, sorted over all parts; `BLOCK_LINES` lines make a compressed
block, and the sparse directory beside a part holds each of its blocks' first and last key and place. Lookup: binary search in
the list of parts and in a part's directory, one range read of a block, binary search in it, one range read of the record.
The query reads every record back that way, and then the response of every revisit.

Scale: archives and index parts are written by the tasks to the folder that driver and executors share, under names that
are unique to an attempt; only the names of attempts that Spark committed are ever read. Payloads are grouped by digest and
length alone, combined before the shuffle; pages are not shuffled while the digests of repeated payloads are few. Index
parts are ranges of the key that are cut with a hash below the key, so one host or URL does not make one part. The list of
parts, one for each partition, is what the driver holds.

Defined cases: null html is an empty payload, null url an empty one; a null page_id stays null, is never referred to and
never refers; repeated rows each give a record; an empty table gives no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, drop_path, hot_join, scratch, table

REVISIT_BYTES, BLOCK_LINES, LEVEL, ARCHIVE_BYTES = 1000, 300, 1, 256 << 20
#: Repeated payloads whose digests are broadcast (about 100 bytes each).
BROADCAST_DIGESTS = 300_000
CONTROL = re.compile(r"[\x00-\x20\x7f\x85\u2028\u2029]")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def key_of(url: str) -> str:
    """Reversed-host key of a URL: host labels from the right, port if any, then path and query, lower case; control characters are escaped."""
    url = CONTROL.sub(lambda m: f"%{ord(m[0]):02x}", url)
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
        tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        key = f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){tail}"
    except ValueError:
        key = url
    return key.lower()


def record(name: str, page_id: int | None, url: str, payload: bytes, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record: a response with the payload, or a revisit without, which names the response by its URI and date. name is unique to the record."""
    revisit = refers_to is not None
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    safe = lambda u: u.replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {safe(url)}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Target-URI: {safe(refers_url or '')}", f"WARC-Refers-To-Date: {DATE}", f"WARC-Refers-To-Page-ID: {refers_to}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class Record(NamedTuple):
    fields: dict[str, str]
    payload: bytes


def parse(data: bytes) -> Record:
    """A record from the bytes of its gzip member; raises ValueError where its lengths do not fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/1.") or rest[n:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    return Record(fields, rest[:n].partition(b"\r\n\r\n")[2])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


INDEX = "key string, page_id long, file string, at long, size long"


def with_references(rows: DataFrame) -> DataFrame:
    """rows (page_id, url, html) with refers_to and refers_url, the response of each revisit. Only names of payloads are grouped.

    Digests of repeated payloads are broadcast up to BROADCAST_DIGESTS of them; beyond that, rows of hot ones stay where they
    are and others are shuffled. Rows that can't repeat one (small, without an id) are never moved."""
    rows = rows.withColumns({"n": F.octet_length("html").cast("long"), "digest": F.unhex(F.sha1("html"))})
    can = (F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull()
    first = F.max(F.struct("page_id", "url"))
    large = rows.where(can).groupBy("digest", "n").agg(first.alias("kept"), F.count("*").alias("copies")).where("copies > 1")
    large = cut(large.select("digest", "n", "copies", "kept"))
    if large.count() <= BROADCAST_DIGESTS:
        marked = rows.where(can).join(F.broadcast(large), ["digest", "n"], "left")
    else:
        marked = hot_join(rows.where(can), large, ["digest", "n"], "copies", "left")
    other = F.col("kept.page_id") != F.col("page_id")
    marked = marked.select("page_id", "url", "html", F.when(other, F.col("kept.page_id")).alias("refers_to"), F.when(other, F.col("kept.url")).alias("refers_url"))
    return marked.unionAll(rows.where(~can).select("page_id", "url", "html", F.lit(None).cast("long"), F.lit(None).cast("string")))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives of pages (page_id, url, html) under folder; one index row for each record."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    marked = with_references(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, name, at, done = TaskContext.get(), None, "", 0, []
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        parts = 0
        for batch in batches:
            done = []
            for page_id, url, html, refers_to, refers_url in zip(*(batch.column(k).cast(pa.binary()).to_pylist() if k == 2 else batch.column(k).to_pylist() for k in range(5)), strict=True):
                if out is None:
                    name, at, parts = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{parts}.warc.gz", 0, parts + 1
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record(f"{name}/{at}", page_id, url, html, refers_to, refers_url)) + packer.flush()
                out.write(member)
                done.append((key_of(url), page_id, name, at, len(member)))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["key", "page_id", "file", "at", "size"])
        if out is not None:
            out.close()

    return cut(marked.mapInArrow(run, INDEX))


PARTS = "first_key string, last_key string, part string, blocks long, lines long"


def index(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the index of rows under folder: sorted parts of compressed blocks and beside each its sparse directory, a line for each
    block; returns the list of parts, a row for each (as many as Spark's shuffle partitions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, at, held, blocks, lines = TaskContext.get(), None, 0, [], [], 0
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}"

        def flush() -> None:
            nonlocal out, at, lines
            if out is None:
                out = system.open_output_stream(f"{base}/{name}.cdx.gz", compression=None)
            block = gzip.compress("".join(f"{k}\t{'' if p is None else p}\t{f}\t{a}\t{s}\n" for k, p, f, a, s in held).encode(), 6, mtime=0)
            out.write(block)
            blocks.append((held[0][0], held[-1][0], at, len(block)))
            at, lines = at + len(block), lines + len(held)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) == BLOCK_LINES:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            with system.open_output_stream(f"{base}/{name}.dir.gz", compression=None) as f:
                f.write(gzip.compress("".join(f"{a}\t{b}\t{c}\t{d}\n" for a, b, c, d in blocks).encode(), 6, mtime=0))
            cols = [[blocks[0][0]], [blocks[-1][1]], [name], [len(blocks)], [lines]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in PARTS.split(", ")])

    names = rows.columns
    keyed = rows.withColumn("salt", F.xxhash64("page_id", "file", "at"))
    # the key's order alone is sorted for; the salt only tells equal keys apart
    return cut(keyed.repartitionByRange("key", "salt").sortWithinPartitions("key", "salt").select(names).mapInArrow(run, PARTS))


Part = tuple[str, str, str]


def part_list(parts: DataFrame) -> list[Part]:
    """(first_key, last_key, part), sorted: the top of the index, a row for each partition that wrote it."""
    return sorted((r.first_key, r.last_key, r.part) for r in parts.collect())


def overlapping(ranges: list[tuple], key: str) -> Iterator[tuple]:
    """Of sorted (first_key, last_key, ...) those that may hold key, found by binary search."""
    at = bisect.bisect_left(ranges, key, key=lambda r: r[1])  # the first whose last key is not before the key
    while at < len(ranges) and ranges[at][0] <= key:
        yield ranges[at]
        at += 1


class Captures:
    """Reads an index: binary search in a part's directory, a range read of a block, binary search in it, a range read of each record."""

    def __init__(self, folder: str):
        self.system, self.base = opened(folder)
        self.directories: dict[str, list[tuple]] = {}
        self.block: tuple[tuple, list[list[str]]] = ((), [])
        self.files: dict[str, pa.NativeFile] = {}

    def read(self, name: str, at: int, size: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            self.files[name] = self.system.open_input_file(f"{self.base}/{name}")
        return self.files[name].read_at(size, at)

    def directory(self, part: str) -> list[tuple]:
        if part not in self.directories:
            if len(self.directories) >= 4:
                self.directories.pop(next(iter(self.directories)))
            with self.system.open_input_file(f"{self.base}/{part}.dir.gz") as f:
                lines = gzip.decompress(f.read()).decode().split("\n")[:-1]
            self.directories[part] = [(a, b, int(c), int(d)) for a, b, c, d in (x.split("\t") for x in lines)]
        return self.directories[part]

    def lines(self, part: str, key: str, page_id: int | None = None) -> Iterator[list[str]]:
        """Index lines of a key in a part, of one page if asked for."""
        for _, _, at, size in overlapping(self.directory(part), key):
            if self.block[0] != (part, at):
                self.block = ((part, at), [x.split("\t") for x in gzip.decompress(self.read(f"{part}.cdx.gz", at, size)).decode().split("\n")[:-1]])
            held = self.block[1]
            k = bisect.bisect_left(held, key, key=lambda x: x[0])
            while k < len(held) and held[k][0] == key:
                if page_id is None or held[k][1] == str(page_id):
                    yield held[k]
                k += 1

    def record(self, line: list[str]) -> Record:
        return parse(zlib.decompress(self.read(line[2], int(line[3]), int(line[4])), 31))


def lookup(parts: list[Part], folder: str, url: str) -> list[Record]:
    """All records of a URL. parts: from part_list()."""
    key, held = key_of(url), Captures(folder)
    return [held.record(line) for _, _, part in overlapping(parts, key) for line in list(held.lines(part, key))]


FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_url string"


def look_up(keys: DataFrame, parts: list[Part], folder: str) -> DataFrame:
    """The records of keys (key, page_id): of each key, of one page where page_id is not null. A row for each record found.

    Keys are named with the parts that may hold them and dealt by part; a key that many parts share makes many tasks."""
    held = keys.sparkSession.sparkContext.broadcast(parts)  # a row for each partition

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(part, key, page) for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True) for _, _, part in overlapping(held.value, key)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["part", "key", "page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        captures = Captures(folder)
        for batch in batches:
            out = []
            for part, key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for line in captures.lines(part, key, page):
                    fields, payload = captures.record(line)
                    kind, n = fields["WARC-Type"], int(fields["WARC-Payload-Length"])
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {key} does not fit its digest")
                    number = lambda name: int(fields[name]) if fields.get(name) else None  # noqa: B023, E731
                    out.append((number("WARC-Page-ID"), fields["WARC-Target-URI"], n, digest, kind, number("WARC-Refers-To-Page-ID"), fields.get("WARC-Refers-To-Target-URI")))
                    if len(out) == 10_000:
                        yield found_batch(out)
                        out = []
            yield found_batch(out)

    dealt = keys.select("key", F.col("page_id").cast("long")).mapInArrow(deal, "part string, key string, page_id long")
    return dealt.repartition(max(1, len(parts)), "part").sortWithinPartitions("part", "key").mapInArrow(run, FOUND)


def found_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=[x.split()[0] for x in FOUND.split(", ")])


def check_references(found: DataFrame, parts: list[Part], folder: str) -> None:
    """Looks up the response of every revisit of found and raises where it is missing or has another payload."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(key_of, batch.column(0).to_pylist()), pa.string()), batch.column(1)], names=["key", "page_id"])

    wanted = cut(found.where("record_type = 'revisit'").select("refers_url", "refers_to", "payload_digest", "payload_bytes").distinct())
    keys = wanted.select("refers_url", "refers_to").mapInArrow(keyed, "key string, page_id long").distinct()
    held = look_up(keys, parts, folder).where("record_type = 'response'").select(F.col("url").alias("refers_url"), F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
    if lost := wanted.join(held, wanted.columns, "left_anti").head(1):
        raise ValueError(f"no response for {lost[0]}")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    rows = write(table(spark, sf_dir, "pages"), folder)
    parts = part_list(index(rows, folder))
    found = cut(look_up(rows.select("key", F.lit(None).cast("long").alias("page_id")).distinct(), parts, folder))
    check_references(found, parts, folder)
    drop_path(spark, folder)
    return found.drop("url", "refers_url")


SQL = f"""
with p as (select page_id, coalesce(html, '') as body from pages),
q as (select page_id, strlen(body) as payload_bytes, sha1(body) as payload_digest from p),
k as (select payload_digest, payload_bytes, max(page_id) as kept from q where page_id is not null group by all)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= {REVISIT_BYTES} and kept <> page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {REVISIT_BYTES} and kept <> page_id then kept end as refers_to
from q left join k using (payload_digest, payload_bytes)
"""
