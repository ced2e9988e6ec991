"""WARC archives: round trips, ZIP64, and what revisits say."""

from __future__ import annotations

import base64
import hashlib
import io
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapelake.llm import warc

PAGES = "page_id long, url string, html string, digest string, path string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", "p") for r in rows], PAGES).repartition(3)


ROWS = [
    (5, "http://a", "<p>é\r\n\r\nWARC/1.1</p>"), (3, "http://b\r\nX: y", "<p>é\r\n\r\nWARC/1.1</p>"),
    (9, None, "<p>é\r\n\r\nWARC/1.1</p>"), (1, "http://c", ""), (2, "http://d", None), (4, "http://e", "x" * 300_000),
    (None, "http://f", "x" * 300_000), (None, "http://g", "alone"), (7, "http://h", "same"), (7, "http://i", "same"),
    (8, "http://j", "日本" * 10),
]


@pytest.mark.parametrize("member", [1, 1 << 23])
def test_pages_come_back_from_archives(spark, monkeypatch, member):
    monkeypatch.setattr(warc, "MEMBER_BYTES", member)
    monkeypatch.setattr(warc, "RANGE_BYTES", 100)
    found = warc.read_archives(warc.write_archives(pages(spark, ROWS))).collect()
    least = {}
    for page_id, _, html in ROWS:
        if page_id is not None:
            least[html or ""] = min(least.get(html or "", page_id), page_id)
    want = Counter()
    for page_id, url, html in ROWS:
        data, first = (html or "").encode(), least.get(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = page_id == first
        kind = "response" if response else "revisit"
        want[page_id, url, kind, None if response else first, len(data), digest, data if response else None] += 1
    assert all(r["intact"] for r in found)
    assert want == Counter(
        (r["page_id"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"],
         None if r["payload"] is None else bytes(r["payload"]))
        for r in found
    )


def test_no_pages_and_short_payloads(spark):
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0
    found = warc.read_archives(warc.write_archives(pages(spark, ROWS), least_bytes=10)).collect()
    kinds = {r["url"]: r["record_type"] for r in found}
    assert kinds["http://d"] == "response" and kinds["http://a"] == "revisit"


def test_zipfile_reads_what_is_written_here(spark):
    manifest = warc.write_archives(pages(spark, ROWS))
    for row in manifest.collect():
        files, place = warc.file_system(row["path"])
        with zipfile.ZipFile(io.BytesIO(files.open_input_file(place).readall())) as archive:
            assert archive.testzip() is None
            assert all(i.compress_type == zipfile.ZIP_STORED for i in archive.infolist())
            ours = [(m.name, m.size) for m in warc.ArchiveReader(row["path"]).members()]
            assert ours == [(i.filename, i.file_size) for i in archive.infolist()]


@pytest.mark.parametrize("zip64", [False, True])
def test_members_of_foreign_archives(tmp_path, zip64):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for name in ("one", "two"):
            with archive.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                member.write(name.encode() * 5)
        archive.writestr("packed", "z" * 99, zipfile.ZIP_DEFLATED)
        archive.comment = b"PK\x05\x06 not the end"
    reader = warc.ArchiveReader(str(path))
    one, two, packed = reader.members()
    assert [reader.range(reader.first_byte(m), m.size) for m in (one, two)] == [b"one" * 5, b"two" * 5]
    with pytest.raises(ValueError, match="compressed"):
        reader.first_byte(packed)
    broken = tmp_path / "b.zip"
    broken.write_bytes(b"no archive at all")
    with pytest.raises(ValueError, match="central directory"):
        warc.ArchiveReader(str(broken)).members()


def test_a_payload_that_all_pages_share_is_spread_over_tasks(spark):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = pages(spark, [(i, f"http://{i}", "error") for i in range(800)]).select("page_id", "url", "html")
        found = warc.with_revisits(rows).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(found) == 800 and max(Counter(r["task"] for r in found).values()) <= 400
    assert {(r["page_id"], r["refers_to"], r["revisit"]) for r in found} == {
        (i, 0 if i else None, i > 0) for i in range(800)
    }
