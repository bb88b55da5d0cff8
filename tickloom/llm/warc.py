"""WARC archives: a deduplicating writer and a salvage reader.

The writer puts each task's records, one gzip member each, into archives in the shared folder and returns a manifest; only
archives named there are read, so what a lost task leaves behind does no harm. Records with equal payloads of at least
min_payload bytes become revisits of the one with the smallest id; groups are found by an aggregate over digests that
combines before the shuffle, and joined back by digest, a join whose hot partitions Spark splits.

The reader checks each record: the member's own checksum, the version line, the lengths and both digests. Where a check
fails it searches on for the next member or version line that starts a record which passes, goes on from there and logs the
bytes between as a quarantined gap. It reads plain records, too. It holds one record in memory at a time.

Defined results: a null payload or address is empty; rows with a null id come last in a group; rows that repeat the
smallest id are all responses; an empty table makes no archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, staged

VERSION, GZIP = b"WARC/1.", b"\x1f\x8b\x08"
MANIFEST = "path string, records long, bytes long"
ROWS = "kind string, path string, offset long, length long, page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, reason string"
#: A payload is one value of a table, which Spark bounds by 2 GiB; a record that claims more than twice that is damaged.
MAX_RECORD_BYTES = 1 << 32
CHUNK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = lambda i: f"<urn:page:{'none' if i is None else i}>"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=-._~"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": name(refers_to)}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str | None = None, min_payload: int = 0, archive_bytes: int = 1 << 30, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a record; the manifest: path, records and bytes of each archive."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("key"))
    same = rows.where(F.length("payload") >= min_payload).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").select("key", "first")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    marked = rows.join(same, "key", "left").select("page_id", "url", "payload", refers_to.alias("refers_to"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        context, out, name, records, size = TaskContext.get(), None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, data, first in zip(*columns, strict=True):
                if out is None:
                    name, records, size = f"part-{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(6, wbits=31)
                member = packer.compress(_record(page_id, url, data or b"", first, date)) + packer.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(marked.mapInArrow(task, MANIFEST), "warc-manifest")


class Damaged(Exception):
    """A check of a record failed."""


class Source:
    """Bytes of a file by offset, read in chunks with one window kept."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.window = file, size, 0, b""

    def bytes(self, start: int, length: int) -> bytes:
        if not (self.at <= start and start + length <= self.at + len(self.window)):
            want = max(length, 16 * CHUNK)
            self.file.seek(start)
            self.at, self.window = start, self.file.read(min(want, max(0, self.size - start)))
        return self.window[start - self.at : start - self.at + length]

    def peek(self, start: int, length: int) -> bytes:
        """A few bytes further on, without giving up the window."""
        if self.at <= start and start + length <= self.at + len(self.window):
            return self.window[start - self.at : start - self.at + length]
        self.file.seek(start)
        return self.file.read(length if start + length <= self.size else max(0, self.size - start))

    def find_start(self, start: int) -> int:
        """Where the next thing that looks like a member or a version line begins; the size if there is none."""
        while start < self.size:
            part = self.bytes(start, 16 * CHUNK)
            places = [i for i in (part.find(GZIP), part.find(VERSION)) if i >= 0]
            if places:
                return start + min(places)
            if start + len(part) >= self.size:
                break
            start += len(part) - len(VERSION)
        return self.size


def _member(source: Source, start: int, limit: int) -> tuple[bytes, int]:
    """Content of the gzip member at start, and where it ends."""
    unpacker, at, parts, size = zlib.decompressobj(wbits=31), start, [], 0
    while not unpacker.eof:
        chunk = source.bytes(at, CHUNK)
        if not chunk:
            raise Damaged("member is cut off")
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error as e:
            raise Damaged(f"member: {e}") from None
        size += len(parts[-1])
        if size > limit:
            raise Damaged("record is too long")
        at += len(chunk) - len(unpacker.unused_data)
    return b"".join(parts), at


_HEADER = re.compile(rb"WARC/1\.[0-9]\r\n((?:[^\r\n:]+:[^\r\n]*\r\n)*)\r\n")


def _fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n") if line)}


def _parsed(data: bytes) -> tuple[dict, int]:
    """The record at the start of data, checked, and its length with the two line ends after it."""
    found = _HEADER.match(data)
    if not found:
        raise Damaged("no version line and header")
    fields = _fields(found[1])
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise Damaged("no content length")
    end = found.end() + int(fields["content-length"])
    block = data[found.end() : end]
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block is cut off")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise Damaged("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    row = {"record_type": fields.get("warc-type", ""), "url": unquote(fields.get("warc-target-uri", "")), "page_id": _page(fields.get("warc-record-id")), "refers_to": _page(fields.get("warc-refers-to"))}
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if row["record_type"] == "response":
        if digest and digest != base32_sha1(payload):
            raise Damaged("payload digest differs")
        row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest or base32_sha1(payload)}
    else:
        length = _fields(http.partition(b"\r\n")[2]).get("content-length")
        row |= {"payload": None, "payload_bytes": int(length) if length and length.isdigit() else None, "payload_digest": digest or None}
    return row, end + 4


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _record_at(source: Source, start: int, limit: int) -> tuple[dict, int]:
    if source.bytes(start, len(GZIP)) == GZIP:
        data, end = _member(source, start, limit)
        row, used = _parsed(data)
        if used != len(data):
            raise Damaged("bytes after the record")
        return row, end
    if source.bytes(start, len(VERSION)) != VERSION:
        raise Damaged("neither a member nor a version line")
    found = None
    for size in (CHUNK, 64 * CHUNK):
        if found := _HEADER.match(source.bytes(start, size)):
            break
    if not found:
        raise Damaged("no version line and header")
    length = _fields(found[1]).get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length) or int(length) > limit:
        raise Damaged("no content length, or too long")
    if source.peek(start + found.end() + int(length), 4) != b"\r\n\r\n":  # before a block is read that may be damage
        raise Damaged("block is cut off")
    row, used = _parsed(source.bytes(start, found.end() + int(length) + 4))
    return row, start + used


def salvage(source: Source, limit: int = MAX_RECORD_BYTES) -> Iterator[dict]:
    """Records and gaps of one archive in order of their offsets."""
    at = 0
    while at < source.size:
        try:
            row, end = _record_at(source, at, limit)
            yield row | {"kind": "record", "offset": at, "length": end - at}
            at = end
        except Damaged as e:
            start, reason = at, str(e)
            at = source.find_start(at + 1)
            while at < source.size:
                try:
                    _record_at(source, at, limit)
                    break
                except Damaged:
                    at = source.find_start(at + 1)
            yield {"kind": "gap", "offset": start, "length": at - start, "reason": reason}


def read_archives(archives: DataFrame, with_payload: bool = True, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """Rows of all archives whose paths are in the column path: records and quarantined gaps, told apart by kind."""
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in ROWS.split(", "))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(at) as file:
                    for row in salvage(Source(file, file.size()), limit):
                        if not with_payload:
                            row.pop("payload", None)
                        rows.append(row | {"path": path})
                        held += len(row.get("payload") or b"") + 300
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    shuffle = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(shuffle, "path").mapInArrow(task, ROWS)
