"""WARC records in ZIP archives: writing them, and reading them by byte ranges.

An archive holds two stored (not compressed) members: ``archive/data.warc.gz``,
gzip members of one record each, and ``indexes/index.cdxj``, one line of JSON per
record with its place. The reader never unpacks an archive. It reads the end of
the file, follows the ZIP64 end record if there is one, parses the central
directory, finds the bytes of the index in the file, and reads records by
their ranges, neighbouring records in one read.

Of pages with equal payloads the one with the smallest id is a ``response``
record; the others are ``revisit`` records without payload that name it, as the
format's identical-payload profile has it. Their HTTP header keeps the length.

Files are read and written through ``pyarrow.fs``, so the folder may be in any
store that it knows; it must be shared by all executors. A task that runs again
writes new files, and only the files that the finished task reports are read.

Defined results: a null html is an empty payload; payloads below ``least_bytes``
are always responses; rows that repeat the smallest id of a payload are responses
too; a null id comes after all others, and is a response where all ids are null;
a null url is empty; no pages give no archives and no records; further columns
are ignored. Payloads of any length are kept whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import scratch_dir

from .common import small_batches, stored

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of payloads after which a task begins another archive, and bytes fetched by one read.
ARCHIVE_BYTES, READ_BYTES = 16 << 20, 4 << 20

ARCHIVES = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
    "refers_to long"
)
#: Fixed values of the formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, END64_PLACE, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
END_SIZE, END64_PLACE_SIZE, LOCAL_SIZE, LONGEST_COMMENT = 22, 20, 30, 65535


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record as bytes."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Target-URI": "".join(c for c in url or "" if c >= " "),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def parse_record(data: bytes) -> dict:
    """The fields of a record; a revisit has no payload, but its length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    return {
        "page_id": _page(warc["warc-record-id"]),
        "url": warc["warc-target-uri"],
        "record_type": warc["warc-type"],
        "payload": None if revisit else payload,
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": warc["warc-payload-digest"].removeprefix("sha1:"),
        "refers_to": _page(warc["warc-refers-to"]) if revisit else None,
    }


class ArchiveWriter:
    """Collects records, then gives the bytes of an archive."""

    def __init__(self) -> None:
        self.data, self.lines, self.payload_bytes = io.BytesIO(), [], 0

    def add(self, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> None:
        packed = gzip.compress(record(page_id, url, payload, digest, refers_to, revisit), 4, mtime=0)
        place = {"offset": self.data.tell(), "length": len(packed), "page": page_id, "digest": f"sha1:{digest}"}
        self.lines.append(json.dumps(place))
        self.data.write(packed)
        self.payload_bytes += len(payload)

    def archive(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as packed:
            for name, data in ((WARC_MEMBER, self.data.getvalue()), (INDEX_MEMBER, "\n".join(self.lines).encode())):
                packed.writestr(zipfile.ZipInfo(name), data)
        return out.getvalue()


class ZipDirectory:
    """The stored members of an archive in a file that is read by ranges.

    ``file`` has ``size()``, ``seek(n)`` and ``read(n)``.
    """

    def __init__(self, file) -> None:
        self.file, self.size = file, file.size()
        self.members = dict(self._entries(*self._directory()))

    def read(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError(f"archive ends before byte {start + length}")
        return data

    def _directory(self) -> tuple[int, int, int]:
        """Where the central directory stands, its length and number of entries."""
        tail_start = max(0, self.size - END_SIZE - LONGEST_COMMENT)
        tail = self.read(tail_start, self.size - tail_start)
        at = tail.rfind(END)
        # A comment may hold the signature; the true record's comment reaches to the end of the file.
        while at >= 0 and at + END_SIZE + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        entries, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            place_start = tail_start + at - END64_PLACE_SIZE
            place = self.read(place_start, END64_PLACE_SIZE) if place_start >= 0 else b""
            if place.startswith(END64_PLACE):
                end64 = self.read(struct.unpack("<Q", place[8:16])[0], 56)
                if not end64.startswith(END64):
                    raise ValueError("no ZIP64 end of central directory where its locator points")
                entries, length, start = struct.unpack("<QQQ", end64[32:56])
        return start, length, entries

    def _entries(self, start: int, length: int, entries: int) -> Iterator[tuple[str, tuple[int, int]]]:
        """Name, first byte of the data and length of each stored member."""
        directory, at = self.read(start, length), 0
        for _ in range(entries):
            if directory[at : at + 4] != ENTRY:
                raise ValueError("broken central directory")
            flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
            packed, whole = struct.unpack("<II", directory[at + 20 : at + 28])
            names, extras, comments = struct.unpack("<HHH", directory[at + 28 : at + 34])
            local = int.from_bytes(directory[at + 42 : at + 46], "little")
            name = directory[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[at + 46 + names : at + 46 + names + extras]
            at += 46 + names + extras + comments
            wide = self._wide_fields(extra)
            if whole == 0xFFFFFFFF:
                whole = next(wide)
            if packed == 0xFFFFFFFF:
                packed = next(wide)
            if local == 0xFFFFFFFF:
                local = next(wide)
            if method == 0:
                head = self.read(local, LOCAL_SIZE)
                if not head.startswith(LOCAL):
                    raise ValueError(f"no local header of {name}")
                yield name, (local + LOCAL_SIZE + sum(struct.unpack("<HH", head[26:30])), packed)

    @staticmethod
    def _wide_fields(extra: bytes) -> Iterator[int]:
        """The 64-bit numbers of the ZIP64 extra field, in order."""
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack("<HH", extra[at : at + 4])
            if kind == 1:
                for k in range(at + 4, at + 4 + length - 7, 8):
                    yield int.from_bytes(extra[k : k + 8], "little")
            at += 4 + length

    def member(self, name: str) -> bytes:
        return self.read(*self.members[name])


def records_of(file) -> Iterator[dict]:
    """All records of an archive, read by the ranges that its index states."""
    archive = ZipDirectory(file)
    first, length = archive.members[WARC_MEMBER]
    places = [json.loads(line) for line in archive.member(INDEX_MEMBER).decode().split("\n") if line]
    at = 0
    while at < len(places):
        start, end, upto = places[at]["offset"], places[at]["offset"] + places[at]["length"], at + 1
        while upto < len(places) and places[upto]["offset"] == end and end - start + places[upto]["length"] <= READ_BYTES:
            end, upto = end + places[upto]["length"], upto + 1
        if end > length:
            raise ValueError("index points behind the records")
        data = archive.read(first + start, end - start)
        for place in places[at:upto]:
            k = place["offset"] - start
            yield parse_record(gzip.decompress(data[k : k + place["length"]]))
        at = upto


def roles(pages: DataFrame, least_bytes: int = 0, id_column="page_id", url_column="url", html_column="html") -> DataFrame:
    """Pages with their payload and, if they revisit another page, that page's id."""
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    rows = rows.withColumn("copied", F.length("payload") >= least_bytes)
    # Grouped by more than the join needs: the result is dealt out again for the join, which then can split hot keys.
    first = rows.where("copied").groupBy("sha1", F.substring("sha1", 1, 2)).agg(F.min("page_id").alias("first"))
    first = first.select(F.col("sha1").alias("_sha1"), "first")
    revisits = F.col("copied") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, F.col("sha1") == F.col("_sha1"), "left").select(
        "page_id", "url", "payload", revisits.alias("revisit"), "first"
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``folder``; one row per archive written."""
    small_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer = ArchiveWriter()

        def flush() -> pa.RecordBatch:
            path, data = f"{root}/{uuid.uuid4().hex}.wacz", writer.archive()
            with store.open_output_stream(path) as out:
                out.write(data)
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": [len(writer.lines)], "bytes": [len(data)]}
            )

        for batch in batches:
            for row in batch.to_pylist():
                writer.add(
                    row["page_id"], row["url"], row["payload"], digest_of(row["payload"]), row["first"], row["revisit"]
                )
                if writer.payload_bytes >= ARCHIVE_BYTES:
                    yield flush()
                    writer = ArchiveWriter()
        if writer.lines:
            yield flush()

    return stored(roles(pages, least_bytes).mapInArrow(write, ARCHIVES), "warc-archives")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives, which are dealt out evenly to tasks."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    for row in records_of(file):
                        payload = row["payload"]
                        if payload is not None and (len(payload), digest_of(payload)) != (
                            row["payload_bytes"], row["payload_digest"]
                        ):
                            raise ValueError(f"{path}: payload of page {row['page_id']} is damaged")
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("path").repartition(archives.sparkSession.sparkContext.defaultParallelism * 2).mapInArrow(
        read, RECORDS
    )


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to a fresh folder of the shared scratch space and read them back, without payloads."""
    folder = scratch_dir(spark, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder, with_payload=False)
