"""Archives: round trip, roles, ZIP64, missing index, members that are not stored."""

import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.llm import warc
from riskweave.llm.queries import op2_warc
from riskweave.session import scratch_path
from tests.llm.data import on_disk

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/", "same"), (5, "http://b/", "same"), (3, None, "same"), (5, "http://b/", "same"), (2, "http://c/\r\nWARC-Type: fake", "é\r\n\r\nWARC/1.1\r\n"),
    (4, "u", None), (6, "u", ""), (None, "n", "same"), (None, "m", "alone"), (None, None, "alone"), (7, "u", "x" * 300_000), (8, "u", "WARC/1.1" * 40),
]


def roles(rows):
    top = {}
    for p, _, h in rows:
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        best, raw = top.get(h or ""), (h or "").encode()
        back = best is not None and best != p
        out.append((p, len(raw), warc.payload_digest(raw), "revisit" if back else "response", best if back else None))
    return sorted(out, key=str)


def test_query_matches_plain_roles(spark, tmp_path):
    frame = spark.createDataFrame([(*r, "x") for r in ROWS], PAGES + ", record_type string")
    on_disk(frame, tmp_path, "pages")
    got = sorted((tuple(r) for r in op2_warc(spark, str(tmp_path)).collect()), key=str)
    assert got == roles(ROWS)


def test_payloads_come_back_from_several_archives(spark):
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * i) for i in range(300)], PAGES)
    manifest = warc.write_archives(warc.record_roles(pages), folder, archive_bytes=2000)
    assert manifest.count() > 3
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(spark, manifest, folder).collect()}
    assert got == {r.page_id: r.html for r in pages.collect()}
    one = warc.read_records(spark, manifest, folder).where("page_id = 7").first()
    assert one.url == "http://h/7" and one.payload_bytes == len("page 7 " * 7)


def test_no_pages(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.record_roles(spark.createDataFrame([], PAGES)), folder)
    assert manifest.count() == 0 and warc.read_records(spark, manifest, folder).count() == 0


def archive(path, deflate=False, index=True, comment=b""):
    writer = warc.ArchiveWriter(str(path), "t")
    for i in range(5):
        writer.add(i, None, f"payload {i}".encode(), "response", None)
    if not index:
        writer.member.close()
        writer.zip.close()
        writer.out.close()
        name = writer.name
    else:
        name, _ = writer.close()
    if deflate or comment:
        old = zipfile.ZipFile(path / name)
        with zipfile.ZipFile(path / ("x" + name), "w", zipfile.ZIP_DEFLATED if deflate else zipfile.ZIP_STORED) as new:
            for m in old.namelist():
                new.writestr(m, old.read(m))
            new.comment = comment
        name = "x" + name
    return name


def read(spark, folder, name):
    manifest = spark.createDataFrame([(name, 5)], "name string, records long")
    return {r.page_id: bytes(r.payload) for r in warc.read_records(spark, manifest, str(folder)).collect()}


WANT = {i: f"payload {i}".encode() for i in range(5)}


def test_zip64_directory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # every size and offset above 10 goes to ZIP64 fields
    name = archive(tmp_path)
    raw = (tmp_path / name).read_bytes()
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw
    assert read(spark, tmp_path, name) == WANT


def test_without_index_the_member_is_scanned(spark, tmp_path):
    assert read(spark, tmp_path, archive(tmp_path, index=False)) == WANT


def test_comment_after_the_directory(spark, tmp_path):
    assert read(spark, tmp_path, archive(tmp_path, comment=b"c" * 60_000)) == WANT


def test_deflated_member_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="not stored"):
        read(spark, tmp_path, archive(tmp_path, deflate=True))


def test_broken_files():
    for raw, what in ((b"", "end record"), (b"no zip" * 50, "end record")):
        with pytest.raises(ValueError, match=what):
            warc.directory(pa.PythonFile(io.BytesIO(raw), mode="r"))


def test_ranges_are_read_by_several_tasks(spark):
    """Adaptive execution must not join partitions by the size of the range rows."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(64)], PAGES)
    manifest = warc.write_archives(warc.record_roles(pages), folder, archive_bytes=1)
    out = warc.read_records(spark, manifest, folder, payload=False).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in out.groupBy("task").count().collect()]
    assert len(counts) > 4 and sum(counts) == 64
