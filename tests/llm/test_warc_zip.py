from __future__ import annotations

import base64
import hashlib
import io
import struct
import zipfile

import pytest

from skyledger.llm import warc_zip

PAGES = "page_id long, url string, html string, first long, payload string"


class File(io.BytesIO):
    """Counts the bytes that are read."""

    taken = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


def archive_bytes() -> bytes:
    writer = warc_zip.ArchiveWriter()
    for k in range(5):
        body = f"<p>{k}</p>".encode() * (k + 1)
        writer.add(k, f"http://x/{k}", body, warc_zip.digest_of(body), None, False)
    writer.add(9, None, b"<p>0</p>", warc_zip.digest_of(b"<p>0</p>"), 0, True)
    return writer.archive()


def test_archive_is_a_plain_zip_and_reads_back():
    data = archive_bytes()
    with zipfile.ZipFile(io.BytesIO(data)) as plain:
        assert plain.testzip() is None and plain.namelist() == [warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER]
        assert {i.compress_type for i in plain.infolist()} == {zipfile.ZIP_STORED}
    rows = list(warc_zip.records_of(File(data)))
    assert [r["page_id"] for r in rows] == [0, 1, 2, 3, 4, 9]
    assert rows[3]["payload"] == b"<p>3</p>" * 4 and rows[3]["url"] == "http://x/3"
    assert rows[5]["payload"] is None and rows[5]["payload_bytes"] == 8 and rows[5]["refers_to"] == 0


def as_zip64(data: bytes) -> bytes:
    """The same archive with 64-bit entries and a ZIP64 end record, and all short fields at their limit."""
    end = data.rfind(warc_zip.END)
    entries, length, start = struct.unpack("<HII", data[end + 10 : end + 20])
    directory, at, out = data[start : start + length], 0, b""
    for _ in range(entries):
        names = int.from_bytes(directory[at + 28 : at + 30], "little")
        packed, whole = struct.unpack("<II", directory[at + 20 : at + 28])
        local = int.from_bytes(directory[at + 42 : at + 46], "little")
        extra = struct.pack("<HH", 0x9999, 2) + b"zz" + struct.pack("<HHQQQ", 1, 24, whole, packed, local)
        out += (
            directory[at : at + 20] + b"\xff" * 8 + struct.pack("<HH", names, len(extra)) + directory[at + 32 : at + 42]
            + b"\xff" * 4 + directory[at + 46 : at + 46 + names] + extra
        )
        at += 46 + names
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, entries, entries, len(out), start)
    place = struct.pack("<4sIQI", b"PK\6\7", 0, start + len(out), 1)
    comment = b"a comment with PK\5\6 in it"
    last = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment))
    return data[:start] + out + end64 + place + last + comment


def test_zip64_directory_and_comment():
    data = archive_bytes()
    assert list(warc_zip.records_of(File(as_zip64(data)))) == list(warc_zip.records_of(File(data)))


def test_only_ranges_are_read():
    writer = warc_zip.ArchiveWriter()
    for k in range(40):
        body = hashlib.sha512(str(k).encode()).hexdigest().encode() * 500
        writer.add(k, "", body, warc_zip.digest_of(body), None, False)
    file = File(writer.archive() + b"")
    archive = warc_zip.ZipDirectory(file)
    archive.member(warc_zip.INDEX_MEMBER)
    assert file.taken < 80_000


@pytest.mark.parametrize("damage", [b"", b"PK\5\6", b"x" * 100])
def test_broken_archives_are_refused(damage):
    with pytest.raises(ValueError):
        warc_zip.ZipDirectory(File(damage))


def test_round_trip(spark, frame):
    big = "long " * 200_000
    rows = [(5, "u5", "same"), (3, "u3", "same"), (8, None, "same"), (1, "a\r\nb", "own"), (2, "u", None), (4, "u", ""),
            (6, "é", "ü☃\r\n\r\nx"), (7, "b", big), (9, "r", "twice"), (9, "r", "twice"), (None, "n", "same"), (None, "n", "none")]
    found = warc_zip.round_trip(spark, frame(PAGES, *[(*r, 0, "") for r in rows])).collect()
    assert len(found) == len(rows)
    payload = {i: (t or "").encode() for i, _, t in rows}
    by_id = {r.page_id: r for r in found if r.page_id is not None}
    for i, r in by_id.items():
        assert r.payload_bytes == len(payload[i])
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload[i]).digest()).decode()
    assert {i for i, r in by_id.items() if r.record_type == "revisit"} == {5, 8, 4}
    assert (by_id[5].refers_to, by_id[8].refers_to, by_id[4].refers_to, by_id[3].refers_to) == (3, 3, 2, None)
    nulls = sorted((r.record_type, r.refers_to) for r in found if r.page_id is None)
    assert nulls == [("response", None), ("revisit", 3)]
    assert [r.record_type for r in found if r.page_id == 9] == ["response", "response"]


def test_small_payloads_and_no_pages(spark, frame):
    pages = frame("page_id long, url string, html string", (1, "", "ab"), (2, "", "ab"), (3, "", "abcd"), (4, "", "abcd"))
    found = {r.page_id: r.record_type for r in warc_zip.round_trip(spark, pages, least_bytes=3).collect()}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc_zip.round_trip(spark, pages.where("false")).count() == 0


def test_payloads_come_back(spark, frame, tmp_path):
    pages = frame("page_id long, url string, html string", (1, "u", "<p>é</p>"))
    archives = warc_zip.write_archives(pages, str(tmp_path / "warc"))
    row = warc_zip.read_archives(archives, str(tmp_path / "warc")).first()
    assert bytes(row.payload).decode() == "<p>é</p>" and row.url == "u"
