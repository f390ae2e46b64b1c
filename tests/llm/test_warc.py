import gzip
import hashlib
import io
import struct
import zipfile

import pytest

from riskloom.llm import warc
from riskloom.llm.queries import op4_warc_packages
from riskloom.llm.warc import DATA, INDEX, Package, archive, package, parse_record, read_archives, record, write_archives

SMALL = "/root/testdata/sf0.001"


def opened(data):
    def read(at, length):
        assert 0 <= at and at + length <= len(data)
        return data[at : at + length]

    return Package(read, len(data))


def expected(pages):
    rows = [(p, (h or "").encode()) for p, h in pages]
    out = []
    for p, data in rows:
        ids = [q for q, d in rows if d == data and q is not None]
        first = min(ids) if ids and len(data) >= 100 else p
        refers = first if first != p else None
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def rows_of(frame):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=lambda r: (r[0] is not None, r))


def test_query_matches_the_rule(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect()
    assert rows_of(op4_warc_packages(spark, SMALL)) == expected(pages)


def test_other_software_reads_our_packages():
    data = b"".join(archive([gzip.compress(record(1, "u", b"x" * 300, "d", None))], [1]))
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        assert file.testzip() is None
        assert file.namelist() == [DATA, INDEX, warc.ABOUT]
        assert parse_record(gzip.decompress(file.read(DATA))).payload == b"x" * 300


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 in it " * 3])
def test_we_read_packages_of_other_software(comment):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as file:
        file.comment = comment
        for i in range(300):
            file.writestr(f"m{i}é", b"%d" % i * i)
        with file.open("wide", "w", force_zip64=True) as member:
            member.write(b"wide")
        file.writestr("packed", b"a" * 1000, zipfile.ZIP_DEFLATED)
    found = opened(out.getvalue())
    assert found.member("m17é") == b"17" * 17 and found.member("wide") == b"wide" and found.member("m0é") == b""
    with pytest.raises(ValueError, match="compressed"):
        found.range_of("packed")


def test_more_members_than_16_bits_count():
    found = opened(b"".join(package([(str(i), b"%d" % i) for i in range(70_000)])))
    assert len(found.members) == 70_000 and found.member("69999") == b"69999"


def test_offsets_beyond_32_bits():
    """A member that begins after 5 GB, in a file of which only the two ends exist."""
    data = b"".join(package([("late", b"here")]))
    far = 5 << 30
    local = data[: data.index(warc.CENTRAL)]
    rest = bytearray(data[len(local) :])
    wide = rest.index(struct.pack("<2H2Q", 1, 24, 4, 4)) + 20
    rest[wide : wide + 8] = struct.pack("<Q", far)
    end = rest.index(warc.END64)
    rest[end + 48 : end + 56] = struct.pack("<Q", far + len(local))
    locator = rest.index(warc.LOCATOR64)
    rest[locator + 8 : locator + 16] = struct.pack("<Q", far + len(local) + end)
    tail = local + bytes(rest)

    def read(at, length):
        return bytes(length) if at < far - 70_000 else (bytes(70_000) + tail)[at - far + 70_000 : at - far + 70_000 + length]

    assert Package(read, far + len(tail)).member("late") == b"here"


@pytest.mark.parametrize("data", [b"", b"PK", b"no package at all" * 10])
def test_what_is_no_package_is_refused(data):
    with pytest.raises(ValueError):
        opened(data)


def test_records_are_read_alone(tmp_path):
    """Not one read covers more than a record, the index or the directory."""
    payloads = [(b"%d " % i) * 2000 for i in range(30)]
    records = [gzip.compress(record(i, None, p, hashlib.sha256(p).hexdigest(), None)) for i, p in enumerate(payloads)]
    path = warc.write_file(tmp_path.as_uri(), "a.zip", *archive(records, list(range(30))))
    with warc.RangeFile(path) as file:
        assert [r.payload for r in warc.read_archive(file)] == payloads


def test_nulls_ties_odd_addresses_and_small_archives(rows):
    long, odd = "same page " * 20, "http://a/\r\nWARC-Type: x ü"
    data = [(5, odd, long, 1), (3, None, long, 2), (None, "u", long, 3), (3, "again", long, 4), (9, "", None, 5), (8, "v", "", 6)]
    data += [(20, "w", "short", 7), (21, "w", "short", 8), (None, "x", "only without an id " * 9, 9), (30, "y", "é" * 50, 1), (31, "y", "é" * 50, 1)]
    data += [(40, "z", "long " * 200_000, 0)]
    frame = rows(data, "page_id long, url string, html string, digest int")
    archives = write_archives(frame, archive_bytes=200)
    back = read_archives(archives)
    assert rows_of(back) == expected([(p, h) for p, _, h, _ in data])
    assert back.filter("page_id = 5").head().url == "http://a/%0D%0AWARC-Type:%20x%20ü"
    assert {bytes(r.payload) for r in back.filter("page_id = 40").collect()} == {b"long " * 200_000}


def test_no_pages(rows):
    assert read_archives(write_archives(rows([], "page_id long, url string, html string"))).count() == 0
