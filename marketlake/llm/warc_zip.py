"""WARC records in ZIP-packaged archives: writer, and a reader that extracts nothing.

An archive is a ZIP of stored members: ``archive/data.warc.gz`` (one gzip member
for each record) and ``indexes/index.cdxj`` (offset and length of each record).
The reader parses the end of the file, the ZIP64 directory where there is one,
and the central directory; it locates the stored members by their local
headers, turns the indexes into one row for each record, deals these rows out
again and range-reads the records, so that one large archive is read by many
tasks.  Any store that ``pyarrow.fs`` opens will do.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
largest page_id is the response, others revisit it.  Archives get fresh names
and only those of tasks that Spark committed are in the manifest, so a task
that runs twice leaves no second copy of a record.

Cases: a null html is an empty payload; a null url leaves its header out; a
null page_id counts as the smallest (a group of nulls alone: all responses);
rows equal in page_id and payload are responses together; an empty table makes
no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, map_arrow, new_folder

#: Fixed values of the ZIP format: signatures and layouts of its records.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
MOST16, MOST32 = 0xFFFF, 0xFFFFFFFF
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records -------------------------------------------------------------------------------------

def record_bytes(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One gzip member with the record; a revisit has the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    urn = lambda i: f"<urn:x-page:{'' if i is None else i}>"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + digest32(payload)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", urn(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(packed: bytes) -> tuple:
    """(page_id, payload_bytes, digest, type, refers_to, payload) of one gzip member; the payload is checked."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda v: int(v[12:-1]) if v and len(v) > 13 else None
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
            payload if fields["WARC-Type"] == "response" else None)


# ---- ZIP directories -----------------------------------------------------------------------------

def directory(read, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, bytes, offset of the local header) of all members; ``read(at, n)`` reads a range."""
    back = min(size, 22 + MOST16)
    tail = read(size - back, back)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != back:
        at = tail.rfind(END, 0, at)  # these bytes belong to the comment
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack("<10xHII", tail[at:at + 20])
    place = size - back + at
    if MOST16 == count or MOST32 in (length, start):
        mark = read(place - 20, 20) if place >= 20 else b""
        if mark[:4] == END64_AT:
            end64 = read(struct.unpack("<8xQ", mark[:16])[0], 56)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end of the directory")
            count, length, start = struct.unpack("<32xQQQ", end64)
    listing, members, at = read(start, length), [], 0
    while at < length:
        if listing[at:at + 4] != ENTRY:
            raise ValueError("no directory entry where one is expected")
        method, packed, plain, n, extra, comment, local = struct.unpack("<10xH8xIIHHH8xI", listing[at:at + 46])
        name = listing[at + 46:at + 46 + n].decode()
        more = listing[at + 46 + n:at + 46 + n + extra]
        while len(more) >= 4:
            kind, k = struct.unpack("<HH", more[:4])
            if kind == 1:  # ZIP64: the values that did not fit, in this order
                held = more[4:4 + k]
                for what in ("plain", "packed", "local"):
                    if {"plain": plain, "packed": packed, "local": local}[what] == MOST32 and len(held) >= 8:
                        value, held = struct.unpack("<Q", held[:8])[0], held[8:]
                        plain, packed, local = (value if what == w else v for w, v in (("plain", plain), ("packed", packed), ("local", local)))
            more = more[4 + k:]
        members.append((name, method, packed, local))
        at += 46 + n + extra + comment
    if len(members) != count:
        raise ValueError(f"the directory names {count} members and holds {len(members)}")
    return members


def data_start(read, local: int) -> int:
    head = read(local, 30)
    if head[:4] != LOCAL:
        raise ValueError("no local header where the directory points")
    n, extra = struct.unpack("<26xHH", head)
    return local + 30 + n + extra


# ---- Spark jobs ----------------------------------------------------------------------------------

def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to; only groups of equal payloads take part in the join's small side."""
    body = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")) \
                .withColumn("digest", F.sha1("payload"))
    groups = body.filter(F.octet_length("payload") >= min_bytes).groupBy("digest") \
                 .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    return body.join(groups, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str | None = None, archive_bytes: int = 64 << 20,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the records of ``marked`` and return the manifest (path, records), one row for each archive."""
    folder = folder or new_folder(marked.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]))
        first = next(rows, None)
        while first is not None:
            path = f"{folder}/{uuid.uuid4().hex}.zip"
            store, place = _store(path)
            store.create_dir(place.rpartition("/")[0], recursive=True)
            entries, at = [], 0
            with store.open_output_stream(place) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
                    while first is not None and at < archive_bytes:
                        page_id, url, payload, refers_to = first
                        packed = record_bytes(page_id, url, payload, refers_to, date)
                        member.write(packed)
                        entries.append({"page": page_id, "offset": at, "length": len(packed)})
                        at += len(packed)
                        first = next(rows, None)
                z.writestr(zipfile.ZipInfo(INDEX), "".join(json.dumps(e) + "\n" for e in entries))
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([len(entries)], pa.int64())})

    return keep(map_arrow(marked, write, "path string, records bigint"), "warc-manifest")


def locate_records(archives: DataFrame) -> DataFrame:
    """(path, offset, length) of every record that the indexes of the archives (column path) name."""
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            store, place = _store(path)
            with store.open_input_file(place) as f:
                read = lambda at, n, f=f: f.read_at(n, at)
                members = {m[0]: m for m in directory(read, f.size())}
                for name in (DATA, INDEX):
                    if members[name][1]:
                        raise ValueError(f"{path}: {name} is not stored")
                base, at = data_start(read, members[DATA][3]), data_start(read, members[INDEX][3])
                end, left = at + members[INDEX][2], b""
                while at < end:  # the index in bounded pieces
                    piece = left + read(at, min(1 << 20, end - at))
                    at += min(1 << 20, end - at)
                    piece, _, left = piece.rpartition(b"\n")
                    got = [json.loads(x) for x in piece.split(b"\n") if x]
                    yield pa.RecordBatch.from_pydict({
                        "path": pa.array([path] * len(got), pa.string()),
                        "offset": pa.array([base + e["offset"] for e in got], pa.int64()),
                        "length": pa.array([e["length"] for e in got], pa.int64())})

    return map_arrow(archives.select("path"), locate, "path string, offset bigint, length bigint")


def read_records(ranges: DataFrame, payloads: bool = False, chunk_bytes: int = 8 << 20) -> DataFrame:
    """Range-read the records; neighbours within ``chunk_bytes`` of an archive are read by one task.

    The tasks are as many as the records' bytes ask for: index rows are tiny, so their own size tells nothing.
    """
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, f = None, None
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            out: list[tuple] = []
            for path, at, n in zip(*[b.column(c).to_pylist() for c in ("path", "offset", "length")]):
                if path != held:
                    if f:
                        f.close()
                    store, place = _store(path)
                    held, f = path, store.open_input_file(place)
                got = parse_record(f.read_at(n, at))
                out.append(got if payloads else (*got[:5], None))
                if len(out) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        if f:
            f.close()

    ranges = keep(ranges, "warc-ranges")
    size = ranges.agg(F.sum("length")).first()[0] or 0
    dealt = ranges.repartition(size // (2 * chunk_bytes) + 1, "path", F.floor(F.col("offset") / chunk_bytes)).sortWithinPartitions("path", "offset")
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return map_arrow(dealt, fetch, schema)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, then read all records back from the archives."""
    return read_records(locate_records(write_archives(mark_revisits(pages, min_bytes)))).drop("payload")
