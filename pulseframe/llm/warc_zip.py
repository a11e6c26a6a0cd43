r"""ZIP-packaged web archives: written by Spark tasks, read by range without extraction.

An archive is a ZIP file with *stored* (uncompressed) members: archives under
``archive/`` (one gzip member per WARC record) and indexes under ``indexes/`` (a line
per record, ending in JSON: file name, offset, length).  The reader

1. finds the end-of-central-directory record from the file's tail, follows the
   ZIP64 locator and record where sizes or counts do not fit, and parses the
   central directory with its ZIP64 extra fields;
2. locates stored members by the directory, whatever their names, and their bytes through
   the local headers;
3. reads the indexes, and each record by its byte range alone.  Records of an archive
   that no index names are found by walking its gzip members, a piece at a time.

Archives are opened through ``pyarrow.fs`` by their URI, so tasks read them
from the cluster's shared store; nothing is unpacked and no archive is read
whole.  Index entries, not archives, are dealt to the tasks that read records,
so one huge archive is read by many.

Writing: every task packs its rows into archives of about ``archive_bytes``,
under names no other attempt uses; the list of finished archives is a written
table, so a retried task leaves at most an unlisted file behind.

Records with equal payloads of at least ``min_bytes`` are deduplicated: the one
with the largest id is a response, the others revisit it.  The largest id per
payload digest is pre-aggregated in every map task, so a payload shared by a
third of the rows stays one row per task in that shuffle; payloads meet their decision by
(id, digest), so the copies of a payload do not meet in one task.

Null html counts as an empty payload.  A null id is smaller than any other;
where all are null, and for repeated rows of the largest id, each is a
response.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import table, written
from pulseframe.session import shared_dir

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 64_000_000
#: Bytes of neighbouring records that one group of range reads covers.
RANGE_BYTES = 8_000_000
MIN_BYTES = 0
WARC_DATE, WARC_TIME = "2000-01-01T00:00:00Z", "20000101000000"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EOCD, _EOCD64, _LOCATOR, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


# ---- reading -------------------------------------------------------------------------------

def open_uri(uri: str):
    """(filesystem, path) of a URI or plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def end_of_directory(tail: bytes, size: int, read) -> tuple[int, int, int]:
    """(entries, bytes, offset) of the central directory.

    ``tail``: the file's last bytes; ``read(offset, length)`` reads a range.  The record
    whose comment ends exactly at the file's end counts; a comment may hold its mark.
    """
    at = tail.rfind(_EOCD)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_EOCD, 0, at)
    if at < 0:
        raise ValueError("no end-of-central-directory record: not a ZIP file, or cut off")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries != 0xFFFF and length != 0xFFFFFFFF and offset != 0xFFFFFFFF:
        return entries, length, offset
    place = size - len(tail) + at - 20
    locator = read(place, 20) if place >= 0 else b""
    if locator[:4] != _LOCATOR:
        return entries, length, offset  # values that are just so large
    record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
    if record[:4] != _EOCD64:
        raise ValueError("the ZIP64 locator does not lead to a ZIP64 record")
    return struct.unpack_from("<QQQ", record, 32)


def central_directory(data: bytes, entries: int) -> dict[str, dict[str, int]]:
    """Members by name: method, flags, size, stored size and local header offset."""
    out, at = {}, 0
    for _ in range(entries):
        if data[at:at + 4] != _CENTRAL:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        stored, size, n, e, c = struct.unpack_from("<IIHHH", data, at + 20)
        offset, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = data[at + 46 + n:at + 46 + n + e], 0
        while k + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # ZIP64: only the fields that do not fit, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                size = next(wide) if size == 0xFFFFFFFF else size
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            k += 4 + length
        out[name] = {"method": method, "flags": flags, "size": size, "stored": stored, "offset": offset}
        at += 46 + n + e + c
    return out


class ZipRanges:
    """Members of a ZIP file behind random access; only directories and asked ranges are read."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        tail = self.read(max(0, self.size - 65_557), min(self.size, 65_557))
        entries, length, offset = end_of_directory(tail, self.size, self.read)
        self.members = central_directory(self.read(offset, length), entries)

    def read(self, offset: int, length: int) -> bytes:
        return self.source.read_at(length, offset)

    def stored_at(self, name: str) -> tuple[int, int]:
        """(offset, length) of a stored member's bytes in the file."""
        member = self.members[name]
        if member["method"] != 0 or member["flags"] & 1:
            raise ValueError(f"{name} is compressed or encrypted: no range of it can be read")
        head = self.read(member["offset"], 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"{name}: no local header")
        n, e = struct.unpack_from("<HH", head, 26)
        return member["offset"] + 30 + n + e, member["stored"]


def parse_record(raw: bytes) -> dict:
    """WARC headers, HTTP headers and payload of one gzipped record."""
    data = gzip.decompress(raw)
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    warc = dict(x.split(": ", 1) for x in lines[1:])
    block = block[:int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in http.decode("utf-8").split("\r\n")[1:])
    return {"warc": warc, "http": headers, "payload": payload}


# ---- writing -------------------------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One gzipped record: a response, or a revisit (headers alone) of page ``refers``."""
    urn = lambda p: f"<urn:page:{'' if p is None else p}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    target = "".join(c for c in url or "" if c >= " ")
    head = [f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {urn(page)}", f"WARC-Date: {WARC_DATE}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            *([] if refers is None else [f"WARC-Refers-To: {urn(refers)}", f"WARC-Profile: {PROFILE}"]),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(["WARC/1.1", *head]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def decide(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    ids = rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", "sha1")
    # only digests that occur more than once, so most rows meet nothing in the joins
    shared = ids.groupBy("sha1").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).filter("n > 1").select(F.col("sha1").alias("s"), "last")
    revisits = (ids.join(shared, F.col("sha1") == F.col("s")).filter(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")))
                .select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "last").distinct())
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha1") == F.col("r_sha1")), "left")
    return joined.select("page_id", "url", "payload", F.col("last").alias("refers_to"))


def write_archives(spark: SparkSession, records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(uri, records, bytes) of the archives written under the cluster's shared folder."""
    folder = shared_dir(spark, "archives")
    schema = pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for big in batches:
                for at in range(0, big.num_rows, 128):
                    yield from zip(*(c.to_pylist() for c in big.slice(at, 128).columns))

        source, done, index, size = rows(), False, [], 0
        while not done:
            first = next(source, None)
            if first is None:
                return
            uri = f"{folder}/{uuid.uuid4().hex}.wacz"
            fs, path = open_uri(uri)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            index, size = [], 0
            with fs.open_output_stream(path) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as archive:
                with archive.open(WARC_MEMBER, "w", force_zip64=True) as member:
                    row = first
                    while row is not None:
                        page, url, payload, refers = row
                        raw = record_bytes(page, url, payload, digest_of(payload), refers)
                        member.write(raw)
                        index.append(f"{WARC_TIME} " + json.dumps({"url": url, "filename": WARC_MEMBER.rpartition("/")[2], "offset": size, "length": len(raw)}))
                        size += len(raw)
                        row = next(source, None) if size < archive_bytes else None
                        done = row is None and size < archive_bytes
                with archive.open(INDEX_MEMBER, "w", force_zip64=True) as member:
                    member.write("\n".join(index).encode())
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(index)]), pa.array([size])], schema=schema)

    return written(spark, records.mapInArrow(run, "uri string, records long, bytes long"), "archive-list")


def walk_members(read, start: int, length: int, piece: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member in a range, found by inflating it piece by piece."""
    at, end, begin, inflate = start, start + length, start, zlib.decompressobj(31)
    while at < end:
        data = read(at, min(piece, end - at))
        if not data:
            raise ValueError("the archive is cut off")
        at += len(data)
        while data:
            inflate.decompress(data)
            if not inflate.eof:
                break
            data = inflate.unused_data
            done = at - len(data)
            yield begin, done - begin
            begin, inflate = done, zlib.decompressobj(31)
    if begin != end:
        raise ValueError("the last record is cut off")


def record_ranges(archive: ZipRanges) -> Iterator[tuple[int, int]]:
    """Absolute (offset, length) of every record of an archive file."""
    stored = {n: archive.stored_at(n) for n in archive.members if n.startswith("archive/") and not n.endswith("/")}
    named = set()
    for index in archive.members:
        if index.startswith("indexes/") and index.endswith((".cdxj", ".cdx")):
            for line in archive.read(*archive.stored_at(index)).decode().split("\n"):
                if "{" in line:
                    entry = json.loads(line[line.index("{"):])
                    # an archive of one member needs no name
                    name = "archive/" + entry["filename"] if "filename" in entry else next(iter(stored)) if len(stored) == 1 else ""
                    if name not in stored:
                        raise ValueError(f"{index} names {name or 'no file'}, which the archive does not hold")
                    named.add(name)
                    yield stored[name][0] + int(entry["offset"]), int(entry["length"])
    for name in sorted(set(stored) - named):
        yield from walk_members(archive.read, *stored[name])


def index_entries(archives: DataFrame) -> DataFrame:
    """(uri, offset, length): the absolute byte range of every record of the archives."""
    schema = pa.schema([("uri", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = open_uri(uri)
                with fs.open_input_file(path) as source:
                    ranges = record_ranges(ZipRanges(source))
                    while part := list(itertools.islice(ranges, 10_000)):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([uri] * len(part)), pa.array([o for o, _ in part], pa.int64()),
                            pa.array([n for _, n in part], pa.int64())], schema=schema)
    return archives.select("uri").mapInArrow(run, "uri string, offset long, length long")


def read_records(entries: DataFrame, partitions: int) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one range read per record."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def page(urn: str | None) -> int | None:
        number = (urn or "")[10:-1]
        return int(number) if number else None

    def rows(uris, offsets, lengths):
        source, name = None, None
        try:
            for uri, offset, length in zip(uris, offsets, lengths):
                if uri != name:
                    if source:
                        source.close()
                    fs, path = open_uri(uri)
                    source, name = fs.open_input_file(path), uri
                record = parse_record(source.read_at(length, offset))
                warc = record["warc"]
                kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and digest_of(record["payload"]) != digest:
                    raise ValueError(f"{warc['WARC-Record-ID']}: the payload does not have its digest")
                yield (page(warc["WARC-Record-ID"]), int(record["http"]["Content-Length"]), digest, kind, page(warc.get("WARC-Refers-To")))
        finally:
            if source:
                source.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(rows(*(c.to_pylist() for c in batch.columns)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    dealt = (entries.repartition(partitions, "uri", (F.col("offset") / RANGE_BYTES).cast("long"))
             .sortWithinPartitions("uri", "offset"))
    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, min_bytes: int = MIN_BYTES) -> DataFrame:
    archives = write_archives(spark, decide(pages, min_bytes), archive_bytes)
    total = archives.agg(F.sum("bytes")).first()[0] or 0
    return read_records(index_entries(archives), max(1, spark.sparkContext.defaultParallelism, -(-total // RANGE_BYTES)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages"))


#: Payload digests and the response of each digest, recomputed from the table.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST(5 * (k // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM d
"""
