"""WARC archives: written by tasks with one gzip member per record, and read back in splits of any byte range.

Writer: equal payloads are found by a group-by on their digests; of each group the record with the largest page id holds
the payload, and the others are revisits of it. Reader: a task scans its byte range for the gzip magic, takes a place for a
record's start if the member there decodes to a WARC header, and owns the records that start inside its range.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, small, stored

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
#: An archive is closed after so many compressed bytes; a split has so many.
ARCHIVE_BYTES, SPLIT_BYTES, WINDOW = 1 << 30, 8 << 20, 1 << 16


def _open(uri: str):
    """The file system of a URI, as seen from a task, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _page(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, revisit: bool, top: int | None) -> bytes:
    name = "" if page_id is None else page_id
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "") or f"urn:x-page:{name}"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:x-page:{name}>"), ("WARC-Date", EPOCH), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{top}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record([*fields, ("Content-Type", "application/http; msgtype=response")], http if revisit else http + payload)


def write(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, level: int = 5) -> DataFrame:
    """Writes the archives under folder, which all executors must see; returns path, bytes and records of each archive.

    pages has page_id, url and html; null html is an empty payload, a null or empty url becomes a urn. Payloads of fewer than
    `least` bytes are never revisits. Rows that share both payload and largest page id are all responses; a row with a null
    id is a revisit if a row with an id has its payload. Names hold the task attempt, so that a repeated task can't disturb
    what another wrote; only archives in the returned list count.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    # Only digests travel, summed up per task first; groups of one need no join.
    groups = rows.where(F.col("size") >= least).groupBy("sha1").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").select("sha1", "top")
    rows = rows.join(small(stored(groups, "payload-groups"), 64), "sha1", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        done: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", size, count))

        for batch in batches:
            for page_id, url, payload, sha1, length, top in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "size", "top")), strict=True):
                if out is None or size >= archive_bytes:
                    close()
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, count = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                    info = _member(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{name}>"), ("WARC-Date", EPOCH), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"), level)
                    out.write(info)
                    size = len(info)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = _member(_page(page_id, url, payload, digest, length, top is not None and page_id != top, top), level)
                out.write(data)
                size, count = size + len(data), count + 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["path", "bytes", "records"])

    return stored(rows.mapInArrow(run, "path string, bytes long, records long"), "archives")


def _find(file, at: int, end: int) -> int:
    """The first place from at and before end where the magic starts, or -1."""
    while at < end:
        file.seek(at)
        data = file.read(min(WINDOW, end - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found >= 0 and at + found < end:
            return at + found
        at += WINDOW
    return -1


def _decode(file, at: int) -> tuple[bytes, int] | None:
    """The record in the gzip member at a place and the place after it; None if no WARC header decodes there."""
    file.seek(at)
    z, got, read = zlib.decompressobj(31), bytearray(), 0
    while not z.eof:
        data = file.read(WINDOW)
        read += len(data)
        try:
            got += z.decompress(data)
        except zlib.error:
            if got[: len(VERSION)] == VERSION:
                raise
            return None
        if len(got) >= 7 and got[:7] != VERSION[:7]:
            return None
        if not data:
            if got[:7] == VERSION[:7]:
                raise ValueError(f"the member at {at} ends early")
            return None
    return (bytes(got), at + read - len(z.unused_data)) if got[:7] == VERSION[:7] else None


def records(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of every record whose member starts in [start, end)."""
    at = _find(file, start, end)
    while at >= 0:
        got = _decode(file, at)
        if got:
            yield at, got[0]
        at = _find(file, got[1] if got else at + 1, end)


def _number(value: str | None) -> int | None:
    tail = (value or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail else None


def parse(data: bytes) -> tuple | None:
    """page_id, url, record type, payload size and digest, refers_to, payload of a page's record; None for other records.

    A response whose payload doesn't have the size and digest it states raises an error.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    kind = field["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = rest[: int(field["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged payload in {field['WARC-Record-ID']}")
    return _number(field["WARC-Record-ID"]), field["WARC-Target-URI"], kind, size, digest, _number(field.get("WARC-Refers-To")), payload if kind == "response" else None


COLUMNS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, path string, offset long"


def read(spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = False) -> DataFrame:
    """A row per page record of the archives (columns path and bytes), in splits of split_bytes; with the payload on request.

    Each record is read by the one split that it starts in, so repeated records give repeated rows; no archives give no rows.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = archives.where("bytes > 0").select("path", F.col("bytes").alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")).repartition(parts)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * payload]
    names = [x.split()[0] for x in COLUMNS.split(", ")] + ["payload"] * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, whole, start in zip(*(batch.column(c).to_pylist() for c in ("path", "whole", "start")), strict=True):
                fs, name = _open(path)
                rows, size = [], 0
                with fs.open_input_file(name) as file:
                    for at, data in records(file, start, min(whole, start + split_bytes)):
                        if page := parse(data):
                            rows.append((*page[:6], path, at, *page[6:][:payload]))
                            size += len(data)
                        if size > WINDOW * 64:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return splits.mapInArrow(run, COLUMNS + ", payload binary" * payload)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Every page written to archives in the shared folder and read back; one row out per row in."""
    spark = pages.sparkSession
    return read(spark, write(pages, scratch(spark, "warc"), least))
