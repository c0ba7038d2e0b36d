"""WARC records in ZIP-packaged web archives: writing, and reading by ranges without extraction.

An archive is a ZIP file whose members are stored (not deflated): archive/data.warc.gz, a WARC
file of one gzip member per record, and indexes/index.cdxj, a line per record with its offset and
length inside the WARC member. Reading takes the end of the file, follows the ZIP64 locator if
there is one, parses the central directory, and reads the index and then the records by byte
ranges; a WARC member without an index is scanned record by record, also by ranges. Members that
are not stored are reported, not read.

Files go through pyarrow's file systems, by the scheme of the folder (local, HDFS, S3), straight
from the tasks. A task writes under a name of its own and reports it when the file is complete;
the manifest of reported files is itself a Parquet table, so a repeated or lost task leaves at
most a file that no manifest names.

Payloads: html as UTF-8, null is empty. Of rows with equal payloads (SHA-1) of at least
`min_revisit_bytes` bytes, that with the largest page_id is a response, repeated rows of that
page_id too; the others are revisits that hold headers only and refer to it. Rows without a
page_id come last in that order: they refer to a page that has one, and among themselves all are
responses. Null urls are left out of the record; an empty table gives an empty table; extra
columns do not reach the archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import posixpath
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded_batches, stored

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
ARCHIVE_BYTES = 256 << 20
# records read with one range request
RANGE_BYTES = 4 << 20
GZIP_LEVEL = 4
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_roles(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"))
    groups = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("sha1", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(stored(groups, "payload-groups"), "sha1", "left").select(
        "page_id", "url", "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def warc_record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if record_type == "revisit" else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if record_type == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes, with_payload: bool) -> dict:
    """Fields of one record. A revisit's payload length is that of the HTTP header it repeats."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    page = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    elif payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "refers_to": page(fields.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": size,
        "payload": payload if with_payload and kind != "revisit" else None,
    }


RECORD_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


class ArchiveWriter:
    """One archive file: WARC records as they come, the index at the end."""

    def __init__(self, folder: str, stem: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"{stem}-{uuid.uuid4().hex[:12]}.wacz"
        self.path = posixpath.join(base, self.name)
        self.out = self.fs.open_output_stream(self.path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.index: list[str] = []
        self.bytes = 0

    def add(self, page_id, url, payload: bytes, record_type: str, refers_to) -> None:
        packed = gzip.compress(warc_record(page_id, url, payload, record_type, refers_to), GZIP_LEVEL, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page_id": page_id, "type": record_type, "offset": self.bytes, "length": len(packed)}))
        self.bytes += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "\n".join(self.index))
        self.zip.close()
        self.out.close()
        return self.name, len(self.index)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes record_roles() rows to archives in folder; returns the manifest (name, records)."""
    bounded_batches(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer = TaskContext.get(), None
        done = lambda w: pa.RecordBatch.from_pydict(dict(zip(("name", "records"), ([x] for x in w.close()), strict=True)))
        for batch in batches:
            columns = [batch.column(i) for i in range(4, -1, -1)]
            for refers_to, kind, payload, url, page_id in zip(*columns, strict=True):
                if writer is None:
                    writer = ArchiveWriter(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}")
                writer.add(page_id.as_py(), url.as_py(), payload.as_py().encode(), kind.as_py(), refers_to.as_py())
                if writer.bytes >= archive_bytes:
                    yield done(writer)
                    writer = None
        if writer is not None:
            yield done(writer)

    return stored(records.select("page_id", "url", "payload", "record_type", "refers_to").mapInArrow(write, "name string, records long"), "manifest")


# ---- reading


def directory(f: pa.NativeFile) -> list[dict]:
    """Members from the central directory: name, method, packed and full size, header offset."""
    size = f.size()
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no ZIP end record")
    n, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == n or 0xFFFFFFFF in (length, offset):
        if at < 20 or tail[at - 20 : at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = f.read_at(56, struct.unpack_from("<Q", tail, at - 12)[0])
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        n, length, offset = struct.unpack_from("<QQQ", end64, 32)
    raw, at, members = f.read_at(length, offset), 0, []
    for _ in range(n):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = raw[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            tag, m = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # ZIP64: only those fields that do not fit, in this order
                wide = iter(struct.unpack_from(f"<{m // 8}Q", extra, x + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            x += 4 + m
        members.append({"name": name, "method": method, "packed": packed, "full": full, "header": header})
        at += 46 + n_name + n_extra + n_comment
    return members


def data_offset(f: pa.NativeFile, member: dict) -> int:
    local = f.read_at(30, member["header"])
    if local[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member['name']}")
    return member["header"] + 30 + sum(struct.unpack_from("<HH", local, 26))


RANGE_SCHEMA = "path string, start long, length long, lengths array<long>, problem string"


def archive_ranges(folder: str, name: str) -> Iterator[dict]:
    """Ranges of whole records of one archive; `lengths` is null for a member to be scanned."""
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(posixpath.join(base, name)) as f:
        members = directory(f)
        index = next((m for m in members if m["name"] == INDEX_MEMBER and m["method"] == 0), None)
        for m in members:
            if not m["name"].endswith(".warc.gz"):
                continue
            if m["method"] != 0:
                yield {"path": name, "problem": f"{m['name']}: not stored (method {m['method']})"}
                continue
            start = data_offset(f, m)
            if index is None or m["name"] != WARC_MEMBER:
                yield {"path": name, "start": start, "length": m["packed"]}
                continue
            lines = f.read_at(index["full"], data_offset(f, index)).decode().splitlines()
            at = total = 0
            lengths: list[int] = []
            for line in lines:
                entry = json.loads(line)
                if lengths and total + entry["length"] > RANGE_BYTES:
                    yield {"path": name, "start": start + at, "length": total, "lengths": lengths}
                    total, lengths = 0, []
                if not lengths:
                    at = entry["offset"]
                lengths.append(entry["length"])
                total += entry["length"]
            if lengths:
                yield {"path": name, "start": start + at, "length": total, "lengths": lengths}


def scan_records(f: pa.NativeFile, start: int, length: int, step: int = 1 << 20) -> Iterator[bytes]:
    """Records of a WARC member without an index: gzip members one after the other."""
    buffer, at, end = b"", start, start + length
    unpack, out = zlib.decompressobj(31), io.BytesIO()
    while buffer or at < end:
        if not buffer:
            buffer = f.read_at(min(step, end - at), at)
            at += len(buffer)
        out.write(unpack.decompress(buffer))
        buffer = unpack.unused_data
        if unpack.eof:
            yield out.getvalue()
            unpack, out = zlib.decompressobj(31), io.BytesIO()


def read_records(spark: SparkSession, manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives that manifest names; payload False leaves that column null."""
    bounded_batches(spark)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = list(archive_ranges(folder, name))
                schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("lengths", pa.list_(pa.int64())), ("problem", pa.string())])
                yield pa.RecordBatch.from_pylist(rows, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if row["problem"]:
                    raise ValueError(f"{row['path']}: {row['problem']}")
                with fs.open_input_file(posixpath.join(base, row["path"])) as f:
                    if row["lengths"] is None:
                        for raw in scan_records(f, row["start"], row["length"]):
                            yield pa.RecordBatch.from_pylist([parse_record(raw, payload)], RECORD_ARROW)
                        continue
                    raw, at, out = f.read_at(row["length"], row["start"]), 0, []
                    for n in row["lengths"]:
                        out.append(parse_record(gzip.decompress(raw[at : at + n]), payload))
                        at += n
                        if payload and len(out) == 64:
                            yield pa.RecordBatch.from_pylist(out, RECORD_ARROW)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_pylist(out, RECORD_ARROW)

    ranges = manifest.select("name").mapInArrow(locate, RANGE_SCHEMA)
    # a stated number: adaptive execution would join partitions by the few bytes of the range rows,
    # not by the bytes that they stand for
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "path", "start").mapInArrow(read, RECORD_SCHEMA)


__all__ = [
    "payload_digest", "record_roles", "warc_record", "parse_record", "ArchiveWriter", "write_archives",
    "directory", "data_offset", "archive_ranges", "scan_records", "read_records",
]
