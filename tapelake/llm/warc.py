"""WARC records in ZIP archives: a writer, and a reader that extracts nothing.

An archive holds stored members: ``data/N.warc.gz`` with records back to back, each a
gzip member of its own as the WARC format has it, and ``index/N.cdxj`` with a line per
record: page id, offset and length within the data member. The reader parses the central directory, by way of the ZIP64
records where there are any, finds each member's first byte from its local header,
reads the index members, and then fetches records by ranges of the archive file.

Archives lie in the shared folder. A task that is run again writes new files, and
the manifest lists the files of the tasks that succeeded only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.llm.columns import inputs, utf8
from tapelake.workspace import materialize, new_folder

MEMBER_BYTES = 8 << 20
ARCHIVE_BYTES = 128 << 20
RANGE_BYTES = 1 << 20
GZIP_LEVEL, GZIP_WINDOW = 3, 31
SALTS = 1024
NO_ID = 2**63 - 1

# The ZIP format's signatures and markers, and WARC's line ends.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
STORED, ZIP64_FIELD, VERSION = 0, 1, 45
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
END_BYTES, END64_BYTES, LOCATOR64_BYTES, LOCAL_BYTES, CENTRAL_BYTES = 22, 56, 20, 30, 46
MOST_COMMENT = 0xFFFF
BREAK = b"\r\n"
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, bytes long, records long"
RANGES = "path string, start long, length long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, intact boolean"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, which tasks on any machine can open."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing -----------------------------------------------------------------------


class ArchiveWriter:
    """Writes stored members one after another, and a ZIP64 directory at the end."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> None:
        self.entries.append((name.encode(), zlib.crc32(data), len(data), self.at))
        sizes = struct.pack("<QQ", len(data), len(data))
        extra = struct.pack("<HH", ZIP64_FIELD, len(sizes)) + sizes
        head = struct.pack(
            "<5H3I2H", VERSION, 0, STORED, 0, 33, zlib.crc32(data), FULL32, FULL32, len(name), len(extra)
        )
        self.write(LOCAL + head + name.encode() + extra)
        self.write(data)

    def close(self) -> None:
        start = self.at
        for name, crc, size, offset in self.entries:
            places = struct.pack("<QQQ", size, size, offset)
            extra = struct.pack("<HH", ZIP64_FIELD, len(places)) + places
            head = struct.pack(
                "<6H3I5H2I", VERSION, VERSION, 0, STORED, 0, 33, crc, FULL32, FULL32,
                len(name), len(extra), 0, 0, 0, 0, FULL32,
            )
            self.write(CENTRAL + head + name + extra)
        size, end64, n = self.at - start, self.at, len(self.entries)
        self.write(END64 + struct.pack("<Q2H2I4Q", END64_BYTES - 12, VERSION, VERSION, 0, 0, n, n, size, start))
        self.write(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self.write(END + struct.pack("<4H2IH", FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))
        self.out.close()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has no block, but names digest and size of its payload."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {json.dumps(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = b"" if revisit else payload
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return BREAK.join([*(line.encode() for line in lines), b"", block, b"", b""])


def archive_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        archive, path, number, records = None, "", 0, 0
        data, index = bytearray(), []

        def flush() -> None:
            nonlocal number
            archive.add(f"data/{number}.warc.gz", bytes(data))
            archive.add(f"index/{number}.cdxj", "".join(index).encode())
            number += 1
            data.clear()
            index.clear()

        def manifest() -> pa.RecordBatch:
            flush()
            archive.close()
            kinds = (pa.string(), pa.int64(), pa.int64())
            row = zip((f"{folder}/{path}", archive.at, records), kinds, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row], names=["path", "bytes", "records"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "refers_to", "revisit")]
            for page_id, url, refers_to, revisit, html in zip(*columns, utf8(batch.column("html")), strict=True):
                if archive is None:
                    path, number, records = f"{uuid.uuid4().hex}.zip", 0, 0
                    archive = ArchiveWriter(files.open_output_stream(f"{root}/{path}"))
                record = gzip.compress(record_bytes(page_id, url, html, refers_to, revisit), GZIP_LEVEL, mtime=0)
                index.append(json.dumps({"id": page_id, "offset": len(data), "length": len(record)}) + "\n")
                data += record
                records += 1
                if len(data) >= MEMBER_BYTES:
                    flush()
                if archive.at >= ARCHIVE_BYTES:
                    yield manifest()
                    archive = None
        if archive is not None:
            yield manifest()

    return write


@F.arrow_udf(T.StringType())
def digest_udf(html: pa.Array) -> pa.Array:
    return pa.array([payload_digest(x) for x in utf8(html)], pa.string())


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``refers_to`` and ``revisit``: of equal payloads of at least ``least_bytes``, the smallest id responds.

    Rows that repeat the smallest id respond too. A missing id is larger than all others.
    Pages are dealt by payload and a salt from id and url, so a payload that many pages
    share is spread over tasks; each pair of the two that occurs has one row with the id.
    """
    rows = pages.withColumn("digest", digest_udf("html"))
    rows = rows.withColumn("key", F.coalesce("page_id", F.lit(NO_ID)))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    first = rows.groupBy("digest", "salt").agg(F.min("key").alias("first"))
    first = first.withColumn("first", F.min("first").over(Window.partitionBy("digest")))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    revisit = (F.col("key") > F.col("first")) & (size >= least_bytes)
    return rows.join(first, ["digest", "salt"]).select(
        "page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(
    pages: DataFrame,
    least_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write every page as a WARC record; the manifest (path, bytes, records) of the archives.

    A null payload counts as empty, a null url stays null. No pages, no archives.
    Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = inputs(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    folder = new_folder(spark, "warc")
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    spark_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark_path)
    written = with_revisits(rows, least_bytes).mapInArrow(archive_writer(folder), MANIFEST)
    return materialize(written, "warc-manifest")


# Reading -----------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header: int


class ArchiveReader:
    """Ranges of one archive file."""

    def __init__(self, path: str):
        files, place = file_system(path)
        self.file = files.open_input_file(place)
        self.size = self.file.size()

    def range(self, start: int, length: int) -> bytes:
        data = self.file.read_at(length, start)
        if len(data) < length:
            raise ValueError("the archive ends early")
        return data

    def directory(self) -> tuple[int, int]:
        """(first byte, bytes) of the central directory."""
        tail_at = max(0, self.size - END_BYTES - MOST_COMMENT)
        tail = self.range(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + END_BYTES + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        size, start = struct.unpack_from("<2I", tail, at + 12)
        marked = FULL32 in (size, start) or FULL16 in struct.unpack_from("<4H", tail, at + 4)
        locator_at = tail_at + at - LOCATOR64_BYTES
        if marked and locator_at >= 0:
            locator = self.range(locator_at, LOCATOR64_BYTES)
            if locator.startswith(LOCATOR64):
                record = self.range(struct.unpack_from("<Q", locator, 8)[0], END64_BYTES)
                if not record.startswith(END64):
                    raise ValueError("no ZIP64 end of a central directory")
                size, start = struct.unpack_from("<2Q", record, 40)
        return start, size

    def members(self) -> list[Member]:
        start, size = self.directory()
        data, at, found = self.range(start, size), 0, []
        while at < size:
            if data[at : at + 4] != CENTRAL:
                raise ValueError("a broken central directory")
            method, = struct.unpack_from("<H", data, at + 10)
            stored, full, name_n, extra_n, comment_n = struct.unpack_from("<2I3H", data, at + 20)
            header, = struct.unpack_from("<I", data, at + 42)
            name = data[at + CENTRAL_BYTES : at + CENTRAL_BYTES + name_n]
            extra = data[at + CENTRAL_BYTES + name_n : at + CENTRAL_BYTES + name_n + extra_n]
            full, stored, header = zip64_values(extra, [full, stored, header])
            found.append(Member(name.decode(), method, full, stored, header))
            at += CENTRAL_BYTES + name_n + extra_n + comment_n
        return found

    def first_byte(self, member: Member) -> int:
        """Where a stored member's own bytes begin."""
        if member.method != STORED:
            raise ValueError(f"{member.name} is compressed")
        head = self.range(member.header, LOCAL_BYTES)
        if not head.startswith(LOCAL):
            raise ValueError(f"{member.name} has no local header")
        return member.header + LOCAL_BYTES + sum(struct.unpack_from("<2H", head, 26))


def zip64_values(extra: bytes, values: list[int]) -> list[int]:
    """Size, stored size and place, taken from the ZIP64 field where they are marked as full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_FIELD:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if v == FULL32 else v for v in values]
        at += 4 + length
    return values


def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranges of about RANGE_BYTES that hold whole records, from the archives' indexes."""
    for batch in batches:
        for path in batch["path"]:
            archive = ArchiveReader(path)
            members = {m.name: m for m in archive.members()}
            rows: list[tuple[str, int, int]] = []
            for name, member in members.items():
                if not name.startswith("index/"):
                    continue
                data = archive.first_byte(members[f"data/{name[6:-5]}.warc.gz"])
                lines = archive.range(archive.first_byte(member), member.size).splitlines()
                start = length = 0
                for line in map(json.loads, lines):
                    if length and length + line["length"] > RANGE_BYTES:
                        rows.append((path, data + start, length))
                        start, length = line["offset"], 0
                    length += line["length"]
                if length:
                    rows.append((path, data + start, length))
            yield pd.DataFrame(rows, columns=["path", "start", "length"])


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of the records that lie back to back, each a gzip member."""
    while data:
        member = zlib.decompressobj(GZIP_WINDOW)
        record, data = member.decompress(data), member.unused_data
        end = record.index(BREAK * 2)
        first, *lines = record[:end].decode().split("\r\n")
        if not first.startswith("WARC/") or not member.eof:
            raise ValueError("no WARC record here")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 2 * len(BREAK)
        yield fields, record[start : start + int(fields["Content-Length"])]


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for place in batch.itertuples(index=False):
            rows = []
            for fields, block in records_in(ArchiveReader(place.path).range(place.start, place.length)):
                named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size, kind = int(fields["WARC-Payload-Length"]), fields["WARC-Type"]
                response = kind == "response"
                rows.append(
                    {
                        "page_id": page_of(fields["WARC-Record-ID"]),
                        "url": json.loads(fields["WARC-Target-URI"]),
                        "record_type": kind,
                        "refers_to": page_of(fields.get("WARC-Refers-To")),
                        "payload": block if response else None,
                        "payload_bytes": len(block) if response else size,
                        "payload_digest": payload_digest(block) if response else named,
                        "intact": not response or (len(block), payload_digest(block)) == (size, named),
                    }
                )
            frame = pd.DataFrame(rows)
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives, read by ranges: RECORDS.

    Revisits have no payload of their own; size and digest are those of the full
    payload. ``intact`` tells whether a response's bytes fit its header.
    """
    places = manifest.select("path").repartition("path").mapInPandas(locate, RANGES)
    return places.repartition("path", "start").mapInPandas(fetch, RECORDS)


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_archives(spark.createDataFrame([(p,) for p in paths], "path string"))
