from __future__ import annotations

import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from flowgauge.llm import warc_zip


class Bytes:
    """What the reader needs of an open file."""

    def __init__(self, raw):
        self.raw = raw

    def size(self):
        return len(self.raw)

    def read_at(self, n, at):
        return self.raw[at : at + n]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows):
    keeper = {}
    for page, html in rows:
        keeper[sha(html)] = max(keeper.get(sha(html), page), page)
    out = []
    for page, html in rows:
        k = keeper[sha(html)]
        out.append((page, len((html or "").encode()), sha(html), "response" if page == k else "revisit", None if page == k else k))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return lambda *rows: spark.createDataFrame(
        [(i, f"http://x.org/{i} ü\r\n", h, "x", 1) for i, h in rows], "page_id long, url string, html string, sha string, size int"
    )


def read(df):
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_round_trip_with_copies(pages):
    rows = [(1, None), (2, ""), (3, "<p>é</p>\r\n\r\n"), (4, "<p>é</p>\r\n\r\n"), (5, "x" * 3_000_000), (6, "<p>é</p>\r\n\r\n"), (7, "z"), (7, "z"), (8, "z")]
    archives = warc_zip.write_archives(pages(*rows))
    assert read(warc_zip.read_archives(archives)) == brute(rows)
    texts = {r.page_id: r.html for r in warc_zip.read_archives(archives, html=True).where("record_type = 'response'").collect()}
    assert texts == {2: "", 6: "<p>é</p>\r\n\r\n", 5: "x" * 3_000_000, 8: "z"}


def test_short_payloads_are_all_responses(pages):
    rows = [(1, "ab"), (2, "ab"), (3, "abcdef"), (4, "abcdef")]
    got = read(warc_zip.read_archives(warc_zip.write_archives(pages(*rows), min_bytes=3)))
    assert [(r[0], r[3], r[4]) for r in got] == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_no_pages(pages):
    archives = warc_zip.write_archives(pages())
    assert archives.count() == 0 and warc_zip.read_archives(archives).count() == 0


def test_archives_are_ordinary_ones(pages):
    archive = warc_zip.write_archives(pages((1, "a"), (2, "b")).coalesce(1)).first().archive
    with zipfile.ZipFile(archive.removeprefix("file://")) as z:
        assert z.testzip() is None
        assert {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        data = z.read(warc_zip.RECORDS)
    inflate = zlib.decompressobj(31)
    assert inflate.decompress(data).startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("zip64", [False, True])
def test_directory_of_other_writers(zip64, monkeypatch):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"a comment"
        z.writestr("one.txt", b"1" * 50)
        z.writestr("two/ü.txt", b"second member")
        z.writestr("three", b"3" * 99, zipfile.ZIP_DEFLATED)
    source = Bytes(raw.getvalue())
    members = warc_zip.central_directory(source, source.size())
    assert set(members) == {"one.txt", "two/ü.txt", "three"}
    at = warc_zip.member_start(source, members["two/ü.txt"])
    assert source.read_at(members["two/ü.txt"][2], at) == b"second member"
    with pytest.raises(warc_zip.NotAnArchive):
        warc_zip.member_start(source, members["three"])


def test_places_beyond_four_gigabytes():
    class Sparse:
        """Counts what is written and keeps only the end."""

        def __init__(self):
            self.at, self.parts = 0, []

        def write(self, data):
            self.parts.append((self.at, bytes(data)))
            self.at += len(data)

    out = Sparse()
    writer = warc_zip.ZipWriter(out)
    writer.open("far")
    writer.close_member()
    writer.at = out.at = 6 << 30
    writer.open("near")
    writer.write(b"found")
    writer.close_member()
    writer.finish()

    class Source:
        def read_at(self, n, at):
            return b"".join(p[max(0, at - a) : at + n - a] for a, p in out.parts if a < at + n and a + len(p) > at)

    members = warc_zip.central_directory(Source(), out.at)
    at = warc_zip.member_start(Source(), members["near"])
    assert at > 6 << 30 and Source().read_at(5, at) == b"found"


@pytest.mark.parametrize("raw", [b"", b"PK", b"x" * 5000, b"PK\5\6"])
def test_no_archive(raw):
    with pytest.raises(warc_zip.NotAnArchive):
        warc_zip.central_directory(Bytes(raw), len(raw))
