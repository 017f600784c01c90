"""WARC archives with a two-level capture index.

Each task writes its pages as records, one gzip member each, to archive files in the shared folder. Captures are
sorted by reversed-host URL key over all tasks; each task writes its range as compressed blocks of lines, and a
sparse directory with the first key of each block. To find a capture, the ranges' first keys are searched, then the
directory of that range, then the one block that is read; the record itself is a range read from its archive.

Of records with equal payloads of at least `least` bytes, those of the smallest page_id are responses and the others
revisits that refer to it. A file's name holds the task attempt, and only files that the manifest names are read,
so tasks may be lost and repeated.

Defined cases: a null html is an empty payload; a page without a URL, or with one without a host, is indexed under
what there is; a null page_id is written without one and is never referred to; repeated rows
are captures of their own, and those of the smallest page_id all responses; an empty table writes no files.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import filesystem, materialise, partitions, shared_dir, small, write_file

LINE = b"\r\n"
NONE = -(1 << 63)  # stands for a null page_id in sort keys
URL = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", re.I)


def url_key(url: str | None) -> str:
    """com,example,www)/path?query"""
    url = (url or "").strip()
    if not (m := URL.match(url)) or not m[1]:
        return url.lower()
    port = f":{m[2]}" if m[2] not in (None, "", "80", "443") else ""
    return ",".join(reversed(m[1].lower().strip(".").split("."))) + port + ")" + (m[3] or "/").lower()


def packed(data: bytes, level: int = 6) -> bytes:
    at = zlib.compressobj(level, zlib.DEFLATED, 31)
    return at.compress(data) + at.flush()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id} {digest}'.encode()).hexdigest())}>"


def header(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int, str | None] | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {header(url)}"] if url else []
    lines += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}"]
    if refers:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers[0], digest)}", f"X-Refers-To-Page-ID: {refers[0]}"]
        lines += [f"WARC-Refers-To-Target-URI: {header(refers[1])}"] if refers[1] else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return LINE.join(x.encode() for x in lines) + LINE * 2 + block + LINE * 2


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.fields["warc-type"]

    @property
    def payload(self) -> bytes | None:
        """What follows the HTTP headers; a revisit has none."""
        return self.block.partition(LINE * 2)[2] if self.kind == "response" else None

    def number(self, name: str) -> int | None:
        return int(self.fields[name]) if name in self.fields else None


def parse(member: bytes) -> Record:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(LINE * 2)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(fields["content-length"])
    if rest[size:] != LINE * 2:
        raise ValueError("a record's length does not hold")
    return Record(fields, rest[:size])


CAPTURE = "url_key string, page_key long, file string, offset long, length long"


def write_archives(pages: DataFrame, root: str, least: int = 100, roll: int = 64 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per page (page_id, url, html); returns the captures' keys and places."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = F.min_by(F.struct("page_id", "url"), F.coalesce("page_id", F.lit((1 << 63) - 1)))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("first.page_id").isNotNull())
    groups = materialise(groups.select(F.col("digest").alias("of"), F.col("first.page_id").alias("refers"), F.col("first.url").alias("refers_url")), "warc-groups")
    again = (F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("refers"))
    marked = rows.join(groups, rows["digest"] == groups["of"], "left").withColumn("refers", F.when(again, F.col("refers")))
    marked = marked.select("page_id", "url", "payload", "digest", "refers", "refers_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out, part, name, offset, n = None, "", "", 0, 0
        at = None
        rows: list[tuple] = []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                at.move(part, f"{folder}/{name}")
                out = None

        def table() -> pa.RecordBatch:
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in CAPTURE.split(", ")])

        at, folder = filesystem(f"{root}/warc")
        for b in small(batches, 8 << 20):
            for page_id, url, payload, digest, refers, refers_url in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    at.create_dir(folder, recursive=True)
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{n:04d}.warc.gz"
                    part, offset, n = f"{folder}/{name}.part", 0, n + 1
                    out = at.open_output_stream(part, compression=None)
                member = packed(record(page_id, url, payload, digest, None if refers is None else (refers, refers_url), date))
                out.write(member)
                rows.append((url_key(url), NONE if page_id is None else page_id, name, offset, len(member)))
                offset += len(member)
                if offset >= roll:
                    close()
            if len(rows) > 20_000:
                close()  # a file that rows name is whole
                yield table()
        close()
        if rows:
            yield table()

    return materialise(marked.mapInArrow(run, CAPTURE), "warc-captures")


@dataclass
class CaptureIndex:
    """The first level: of each range its file and first key. Its size is that of the ranges, a parameter."""

    root: str
    ranges: list[tuple[bytes, int, str, str]]  # first URL key, first page key, index file, directory file

    @staticmethod
    def build(captures: DataFrame, root: str, block: int = 512, ranges: int | None = None) -> CaptureIndex:
        spark = captures.sparkSession

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
            blocks, directory, held, offset = [], [], [], 0

            def put() -> None:
                nonlocal offset
                data = packed("\n".join(json.dumps(x, ensure_ascii=False) for x in held).encode())
                directory.append((held[0][0], held[0][1], offset, len(data)))
                blocks.append(data)
                offset += len(data)
                held.clear()

            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    held.append(row)
                    if len(held) == block:
                        put()
            if held:
                put()
            if directory:
                write_file(f"{root}/index/{name}.cdx.gz", b"".join(blocks))
                write_file(f"{root}/index/{name}.dir", packed(json.dumps(directory).encode()))
                yield pa.RecordBatch.from_pydict({"url_key": [directory[0][0]], "page_key": [directory[0][1]], "file": [f"{name}.cdx.gz"], "directory": [f"{name}.dir"]})

        order = ["url_key", "page_key", "file", "offset"]
        ordered = captures.repartitionByRange(ranges or partitions(spark), *order).sortWithinPartitions(*order)
        found = materialise(ordered.mapInArrow(run, "url_key string, page_key long, file string, directory string"), "warc-ranges")
        return CaptureIndex(root, sorted((r[0].encode(), r[1], r[2], r[3]) for r in found.collect()))

    def find(self, keys: DataFrame) -> DataFrame:
        """The captures of each distinct (url_key, page_key); keys come in order, so that a task reads few blocks."""
        index = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(index)
            for b in batches:
                rows = [x for key, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in finder.find(key, page)]
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in CAPTURE.split(", ")])

        keys = keys.select("url_key", "page_key").distinct()
        ordered = keys.repartitionByRange(partitions(keys.sparkSession), "url_key", "page_key").sortWithinPartitions("url_key", "page_key")
        return ordered.mapInArrow(run, CAPTURE)


class Finder:
    """Searches on one machine; keeps the last directory and block."""

    def __init__(self, index: CaptureIndex):
        self.index, self.firsts = index, [x[:2] for x in index.ranges]
        self.at, self.folder = filesystem(f"{index.root}/index")
        self.directory: tuple[int, list] = (-1, [])
        self.block: tuple[tuple, list] = ((), [])

    def entries(self, k: int) -> list:
        if self.directory[0] != k:
            with self.at.open_input_file(f"{self.folder}/{self.index.ranges[k][3]}") as f:
                rows = json.loads(zlib.decompress(f.read(), 31))
            self.directory = k, [((key.encode(), page), offset, length) for key, page, offset, length in rows]
        return self.directory[1]

    def lines(self, k: int, offset: int, length: int) -> list:
        if self.block[0] != (k, offset):
            with self.at.open_input_file(f"{self.folder}/{self.index.ranges[k][2]}") as f:
                rows = [json.loads(x) for x in zlib.decompress(f.read_at(length, offset), 31).split(b"\n")]
            self.block = (k, offset), [((x[0].encode(), x[1]), x) for x in rows]
        return self.block[1]

    def find(self, key: str, page: int | None = None) -> Iterator[tuple]:
        """Captures of a URL key, of one page or of all; those of one key may go over blocks and ranges."""
        low = (key.encode(), NONE if page is None else page)
        high = (key.encode(), 1 << 64 if page is None else page)
        k = max(0, bisect_left(self.firsts, low) - 1)
        while k < len(self.firsts) and self.firsts[k] <= high:
            entries = self.entries(k)
            n = max(0, bisect_left(entries, low, key=lambda x: x[0]) - 1)
            for _, offset, length in entries[n : bisect_right(entries, high, key=lambda x: x[0])]:
                lines = self.lines(k, offset, length)
                for _, row in lines[bisect_left(lines, low, key=lambda x: x[0]) : bisect_right(lines, high, key=lambda x: x[0])]:
                    yield tuple(row)
            k += 1


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, named_digest string"


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """The records at these places, each by a range read; payload_digest is of the bytes read (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, folder = filesystem(f"{root}/warc")
        name, f = None, None
        for b in batches:
            rows = []
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, at.open_input_file(f"{folder}/{file}")
                r = parse(f.read_at(length, offset))
                p = r.payload
                rows.append((r.number("x-page-id"), r.fields.get("warc-target-uri"), r.kind, r.number("x-refers-to-page-id"), None if p is None else len(p), None if p is None else hashlib.sha256(p).hexdigest(), r.fields["warc-payload-digest"].removeprefix("sha256:")))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in READ.split(", ")])
        if f is not None:
            f.close()

    n = partitions(captures.sparkSession)
    # an archive's records lie together; archives are of bounded size
    ordered = captures.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, READ)


def resolved(records: DataFrame) -> DataFrame:
    """`records` with the payloads' size and digest that revisits refer to."""
    full = records.where("record_type = 'response'").select(F.col("page_id").alias("o_id"), F.col("payload_digest").alias("o_digest"), F.col("payload_bytes").alias("o_bytes")).distinct()
    revisits = records.where("record_type = 'revisit'").drop("payload_digest", "payload_bytes")
    met = revisits.join(full, (F.col("refers_to") == F.col("o_id")) & (F.col("named_digest") == F.col("o_digest")), "left")
    met = met.withColumnsRenamed({"o_digest": "payload_digest", "o_bytes": "payload_bytes"}).select(*records.columns)
    return records.where("record_type = 'response'").unionByName(met)


def archive(spark: SparkSession, pages: DataFrame, root: str | None = None) -> tuple[str, CaptureIndex]:
    """Archives and index of all pages, below `root`."""
    root = root or shared_dir(spark, "warc")
    return root, CaptureIndex.build(write_archives(pages, root), root)


def keyed(pages: DataFrame) -> DataFrame:
    """url_key and page_key of pages (page_id, url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [url_key(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), b.column(0).fill_null(NONE)], ["url_key", "page_key"])

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string")).mapInArrow(run, "url_key string, page_key long")
