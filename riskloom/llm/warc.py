"""WARC records in ZIP packages, read by byte range without extraction.

An archive is a ZIP package of three stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member a
record; ``indexes/index.tsv``, a line a record with its offset and length in the member before; and ``datapackage.json``,
the counts. Sizes and offsets are written in ZIP64 form throughout, so an archive may pass 4 GB and 65,535 members.

The reader works on byte ranges: the end of the file for the end record, the ZIP64 locator and the ZIP64 end record;
the central directory; the local header of the member wanted; then the index, and each record by its
offset. A member that is compressed or encrypted cannot be addressed that way and is refused.

Of records with equal payloads of at least ``LEAST_BYTES`` bytes, that with the smallest page id is the response; the others
are revisits, which carry headers and the digest but no payload. Smaller payloads are all responses.

Defined results: null html is an empty payload. Rows without a page id never are what others refer to; they revisit
a page with an id if there is one, and are responses else. Rows that share the smallest id are all responses.
Line breaks and other control characters of an address are percent-encoded. No pages: no archives.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import task_count
from riskloom.llm.files import RangeFile, fresh_folder, write_file
from riskloom.session import stored

LEAST_BYTES = 100
#: Compressed bytes of records in an archive, about.
ARCHIVE_BYTES = 32_000_000
DATA, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.tsv", "datapackage.json"
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the two formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
#: The end record and the longest comment after it.
TAIL = 22 + FULL16


# Records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit if it refers to another."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    address = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", address),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if revisit else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    def page(self, name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", self.headers.get(name, ""))
        return int(found[1]) if found else None


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode().split("\r\n")
    pairs = (line.partition(":") for line in lines if line)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(data: bytes) -> Record:
    """A record from its uncompressed bytes."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, headers = _fields(head)
    if not gap or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    http_head, _, payload = rest[:length].partition(b"\r\n\r\n")
    return Record(headers, _fields(http_head)[1], payload)


# Packages


def package(members: list[tuple[str, bytes]]) -> Iterator[bytes]:
    """The bytes of a ZIP64 package of stored members."""
    at, directory = 0, []
    for name, data in members:
        encoded, check = name.encode(), zlib.crc32(data)
        fixed = (45, 0x800, 0, 0, 0x21, check, FULL32, FULL32, len(encoded))
        sizes = struct.pack("<2H2Q", 1, 16, len(data), len(data))
        local = LOCAL + struct.pack("<5H3L2H", *fixed, len(sizes)) + encoded + sizes
        extra = struct.pack("<2H3Q", 1, 24, len(data), len(data), at)
        directory.append(CENTRAL + struct.pack("<6H3L5H2L", 45, *fixed, len(extra), 0, 0, 0, 0, FULL32) + encoded + extra)
        yield local
        yield data
        at += len(local) + len(data)
    listed = b"".join(directory)
    yield listed
    count = len(members)
    yield END64 + struct.pack("<Q2H2L4Q", 44, 45, 45, 0, 0, count, count, len(listed), at)
    yield LOCATOR64 + struct.pack("<LQL", 0, at + len(listed), 1)
    yield END + struct.pack("<4H2LH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)


@dataclass
class Member:
    name: str
    method: int
    flags: int
    stored: int
    size: int
    header: int


class Package:
    """The members of a ZIP package, located through a function that reads a byte range."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self._read, self._size = read, size
        self.members = {m.name: m for m in self._directory()}

    def _ends(self) -> tuple[int, int, int]:
        """Count of members, and length and offset of the central directory."""
        length = min(self._size, TAIL)
        tail, start = self._read(self._size - length, length), self._size - length
        at = tail.rfind(END)
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != length:
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP package, or cut off")
        _, _, _, count, listed, offset, _ = struct.unpack("<4H2LH", tail[at + 4 : at + 22])
        locator = self._read(start + at - 20, 20) if start + at >= 20 else b""
        if locator[:4] == LOCATOR64 and (count == FULL16 or FULL32 in (listed, offset)):
            _, where, _ = struct.unpack("<LQL", locator[4:])
            end = self._read(where, 56)
            if end[:4] != END64:
                raise ValueError("no ZIP64 end record where its locator says")
            *_, count, listed, offset = struct.unpack("<Q2H2L4Q", end[4:])
        return count, listed, offset

    def _directory(self) -> Iterator[Member]:
        count, listed, offset = self._ends()
        data, at = self._read(offset, listed), 0
        for _ in range(count):
            if data[at : at + 4] != CENTRAL:
                raise ValueError("a broken central directory")
            (_, _, flags, method, _, _, _, packed, size, name, extra, comment, _, _, _, header) = struct.unpack(
                "<6H3L5H2L", data[at + 4 : at + 46]
            )
            name_at, extra_at = at + 46, at + 46 + name
            wide = self._wide(data[extra_at : extra_at + extra])
            # In this order, and only those that did not fit.
            size = next(wide) if size == FULL32 else size
            packed = next(wide) if packed == FULL32 else packed
            header = next(wide) if header == FULL32 else header
            text = data[name_at:extra_at].decode("utf-8" if flags & 0x800 else "cp437")
            yield Member(text, method, flags, packed, size, header)
            at = extra_at + extra + comment

    @staticmethod
    def _wide(extra: bytes) -> Iterator[int]:
        """The 64-bit numbers of the ZIP64 extra field."""
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack("<2H", extra[at : at + 4])
            if kind == 1:
                for place in range(at + 4, at + 4 + length // 8 * 8, 8):
                    yield int.from_bytes(extra[place : place + 8], "little")
                break
            at += 4 + length
        raise ValueError("a size that the ZIP64 field should hold is missing")

    def range_of(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin in the file, and how many there are."""
        member = self.members[name]
        if member.method != 0 or member.flags & 1 or member.stored != member.size:
            raise ValueError(f"{name} is compressed or encrypted, so it has no addressable bytes")
        head = self._read(member.header, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        name_length, extra_length = struct.unpack("<2H", head[26:30])
        return member.header + 30 + name_length + extra_length, member.size

    def member(self, name: str) -> bytes:
        return self._read(*self.range_of(name))


def archive(records: list[bytes], ids: list[int | None]) -> list[bytes]:
    """The parts of an archive file of gzip members, one a record."""
    at, lines = 0, []
    for data, page_id in zip(records, ids, strict=True):
        lines.append(f"{'' if page_id is None else page_id}\t{at}\t{len(data)}\n")
        at += len(data)
    about = json.dumps({"records": len(records), "bytes": at}).encode()
    return list(package([(DATA, b"".join(records)), (INDEX, "".join(lines).encode()), (ABOUT, about)]))


def read_archive(file: RangeFile) -> Iterator[Record]:
    """The records of an archive, each by its own byte range."""
    found = Package(file.read, file.size)
    start, size = found.range_of(DATA)
    for line in found.member(INDEX).decode().splitlines():
        _, offset, length = line.split("\t")
        offset, length = int(offset), int(length)
        if offset + length > size:
            raise ValueError("an index entry outside its member")
        yield parse_record(gzip.decompress(file.read(start + offset, length)))


# Tables


def typed(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: which records are revisits, and of what."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_ = rows.filter(F.octet_length("payload") >= LEAST_BYTES)
    first = long_.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Only digests that repeat. Stored, so that Spark knows the size and broadcasts them only if they are few;
    # otherwise it may split the join of a digest with many rows, as nothing after it needs them together.
    repeated = stored(first.filter("n > 1").select("digest", "first"))
    joined = rows.join(repeated, "digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages into archives; ``path, records, bytes``, one row an archive, stored."""
    folder = fresh_folder(pages.sparkSession, "archives")
    result = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ids, held, number = [], [], 0, 0

        def close() -> pa.RecordBatch:
            data = archive(parts, ids)
            path = write_file(folder, f"{number:06d}.zip", *data)
            row = {"path": path, "records": len(parts), "bytes": sum(map(len, data))}
            return pa.RecordBatch.from_pylist([row], result)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.append(gzip.compress(record(*row), 6, mtime=0))
                ids.append(row[0])
                held += len(parts[-1])
                if held >= archive_bytes:
                    yield close()
                    parts, ids, held, number = [], [], 0, number + 1
        if parts:
            yield close()

    return stored(typed(pages).mapInArrow(run, "path string, records bigint, bytes bigint"))


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``.

    Length and digest are those of the full payload: of a response, as read and compared with its header; of
    a revisit, which has no payload here (null), as its headers tell.
    """
    result = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def row_of(found: Record) -> tuple:
        kind, url = found.headers["warc-type"], found.headers["warc-target-uri"]
        digest = found.headers["warc-payload-digest"].removeprefix("sha256:")
        length, payload = int(found.http["content-length"]), None
        if kind == "response":
            payload = found.payload
            if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"a damaged payload of page {found.page('warc-record-id')}")
        ids = found.page("warc-record-id"), found.page("warc-refers-to")
        return ids[0], url, kind, ids[1], length, digest, payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with RangeFile(path) as file:
                    rows = []
                    for found in read_archive(file):
                        rows.append(row_of(found))
                        if len(rows) == 1000:
                            yield _batch(rows, result)
                            rows = []
                    if rows:
                        yield _batch(rows, result)

    fields = (
        "page_id bigint, url string, record_type string, refers_to bigint, "
        "payload_bytes bigint, payload_digest string, payload binary"
    )
    return archives.select("path").repartition(task_count(archives)).mapInArrow(run, fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )
