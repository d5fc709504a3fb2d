"""WARC records in ZIP archives: exact round trip, ZIP64, damaged files."""

import base64
import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from marketlake.llm import warc_zip

SCHEMA = "page_id long, url string, html string"


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def _expect(rows, least):
    out = []
    for i, _, html in rows:
        size = len((html or "").encode())
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        top = max(ids) if ids and size >= least else i
        out.append((i, size, _digest(html), "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nEvil: 1", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "né 日本 🙂"),
            (6, "u", "Content-Length: 9\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>x</p>"), (7, "u", "z" * 300_000), (8, "u", "abc"), (9, "u", "abc"), (9, "u", "abc")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("clash")).withColumn("path", F.lit(1))
    got = sorted(map(tuple, warc_zip.round_trip(spark, pages, least).collect()), key=str)
    assert got == _expect(rows, least)


def test_payloads_come_back_from_several_archives(spark):
    rows = [(i, f"http://x/{i}", f"<html>{i} " + "y" * (i * 37 % 900)) for i in range(300)]
    marked = warc_zip.mark_revisits(spark.createDataFrame(rows, SCHEMA))
    manifest = warc_zip.write_archives(marked.repartition(2), archive_bytes=4_000)
    assert manifest.count() > 4 and manifest.agg(F.sum("records")).first()[0] == 300
    got = warc_zip.read_records(warc_zip.locate_records(manifest), payloads=True, chunk_bytes=1000)
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in got.collect()) == [(i, h) for i, _, h in rows]


def test_empty_table(spark):
    assert warc_zip.round_trip(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def _read(data):
    return lambda at, n: data[at:at + n]


def test_directory_of_a_plain_archive_with_comment():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"hello")
        z.writestr("dir/é.bin", b"x" * 99)
        z.comment = warc_zip.END + b" is not the end, and the comment goes on"
    data = buf.getvalue()
    held = {}
    for name, method, size, local in warc_zip.directory(_read(data), len(data)):
        at = warc_zip.data_start(_read(data), local)
        assert method == 0
        held[name] = data[at:at + size]
    assert held == {"a.txt": b"hello", "dir/é.bin": b"x" * 99}


def test_zip64_directory():
    """All values that fit nowhere else stand in the ZIP64 records."""
    name, body = b"big.bin", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", warc_zip.LOCAL, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), 20) + name + \
        struct.pack("<HHQQ", 1, 16, len(body), len(body))
    at = len(local) + len(body)
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", warc_zip.ENTRY, 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), len(extra), 0, 0, 0, 0, 2**32 - 1) + name + extra
    end64 = struct.pack("<4sQHHIIQQQQ", warc_zip.END64, 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    mark = struct.pack("<4sIQI", warc_zip.END64_AT, 0, at + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", warc_zip.END, 0, 0, 2**16 - 1, 2**16 - 1, 2**32 - 1, 2**32 - 1, 0)
    data = local + body + entry + end64 + mark + end
    assert warc_zip.directory(_read(data), len(data)) == [("big.bin", 0, len(body), 0)]
    start = warc_zip.data_start(_read(data), 0)
    assert data[start:start + len(body)] == body


def test_damage_is_reported():
    with pytest.raises(ValueError):
        warc_zip.directory(_read(b"no archive"), 10)
    good = warc_zip.record_bytes(1, "u", b"abc", None, "1970-01-01T00:00:00Z")
    assert warc_zip.parse_record(good)[:4] == (1, 3, _digest("abc"), "response")
    import zlib
    bad = zlib.decompress(good, 31).replace(b"abc", b"abd")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        warc_zip.parse_record(packer.compress(bad) + packer.flush())
