"""WARC records in ZIP archives, written and read in place.

A task writes one archive: a member of records, each compressed by itself, and a member
with an index of them.  Both members are stored, not compressed again, so a record can
be read from the archive by its place alone.  Reading parses the central directory, with
its ZIP64 parts, locates the members, takes the index and reads records by range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import col, cut, shared_dir, ship

ship(__name__)

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A central directory's end lies at most so far from the end of the file (its comment is 64 KB at most).
TAIL = 22 + 65535 + 20
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


class NotAnArchive(ValueError):
    """A file that is cut off, or no ZIP archive with stored members."""


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing -------------------------------------------------------------------------


_UNSAFE = re.compile(r"[\x00-\x20\x7f-\xa0]")


def record(page: str, url: str, payload: bytes, sha: str, size: int, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit that names the response with the same payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {_UNSAFE.sub(lambda m: quote(m[0]), url)}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Payload-Length: {size}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


class ZipWriter:
    """Stored members in order; sizes follow the data, and ZIP64 fields are always written."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def open(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # Bit 3: sizes and checksum come after the data; bit 11: the name is UTF-8.
        self._put(struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0x808, 0, 0, 33, 0, _MAX32, _MAX32, len(raw), len(extra)))
        self._put(raw + extra)

    def write(self, data: bytes) -> int:
        """The place of ``data`` within the open member."""
        member = self.members[-1]
        at = member[2]
        member[2], member[3] = at + len(data), zlib.crc32(data, member[3])
        self._put(data)
        return at

    def close_member(self) -> None:
        _, _, size, crc = self.members[-1]
        self._put(struct.pack("<4sIQQ", b"PK\7\x08", crc, size, size))

    def finish(self) -> None:
        start = self.at
        for raw, at, size, crc in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            self._put(
                struct.pack(
                    "<4sHHHHHHIIIHHHHHII",
                    *(b"PK\1\2", 45, 45, 0x808, 0, 0, 33, crc, _MAX32, _MAX32, len(raw), len(extra), 0, 0, 0, 0, _MAX32),
                )
            )
            self._put(raw + extra)
        size, n, end = self.at - start, len(self.members), self.at
        self._put(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
        self._put(struct.pack("<4sHHHHIIH", b"PK\5\6", _MAX16, _MAX16, _MAX16, _MAX16, _MAX32, _MAX32, 0))


def _write_archive(batches, folder: str):
    """One archive for the task; each attempt has a name of its own, and only a finished one is reported."""
    batches = iter(batches)
    first = next((b for b in batches if b.num_rows), None)
    if first is None:
        return
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.zip"
    lines = []
    with files.open_output_stream(f"{root}/{name}") as out:
        archive = ZipWriter(out)
        archive.open(RECORDS)
        while first is not None:
            for page, url, html, sha, size, refers in zip(*(c.to_pylist() for c in first.columns)):
                sha = base64.b32encode(bytes.fromhex(sha)).decode()
                refers = None if refers is None else quote(refers, "")
                packed = record(quote(page or "", ""), url or "", html, sha, size, refers)
                lines.append(json.dumps({"offset": archive.write(packed), "length": len(packed)}))
            first = next(batches, None)
        archive.close_member()
        archive.open(INDEX)
        for i in range(0, len(lines), 10_000):
            archive.write(("\n".join(lines[i : i + 10_000]) + "\n").encode())
        archive.close_member()
        archive.finish()
    yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [len(lines)]})


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write a record per row; (archive, records) of the archives, which lie below ``folder``.

    The payload is the html in UTF-8, a null is empty.  Of rows with equal payloads of
    at least ``min_bytes`` bytes, that with the largest id is a response, the others
    are revisits of it; rows that repeat the largest id are responses too.  A null id
    counts as smallest.  The folder has to be one that all executors reach; it is made
    in the shared folder if none is given.
    """
    folder = folder or f"{shared_dir(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    folder = re.sub(r"^file:/+", "file:///", folder)
    payload = F.coalesce(col(html).cast("binary"), F.lit(b""))
    size = F.octet_length(payload).cast("long")
    narrow = pages.select(F.sha1(payload).alias("of"), size.alias("size"), col(id).alias("id"))
    keepers = (
        narrow.where(F.col("size") >= min_bytes)
        .groupBy("of")
        .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    rows = pages.select(
        col(id).alias("id"), col(url).alias("url"), payload.alias("html"), size.alias("size"), F.sha1(payload).alias("sha")
    )
    of_keeper = F.when(F.col("of").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    joined = rows.join(keepers, F.col("sha") == F.col("of"), "left").select(
        F.col("id").cast("string").alias("page"),
        F.col("url").cast("string").alias("url"),
        F.when(of_keeper.isNull(), F.col("html")).alias("html"),
        "sha",
        "size",
        of_keeper.cast("string").alias("refers"),
    )
    return cut(joined.mapInArrow(lambda b: _write_archive(b, folder), "archive string, records long"))


# --- reading -------------------------------------------------------------------------


def central_directory(source, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Members by name: (method, compressed size, size, offset of the local header)."""
    tail = source.read_at(min(size, TAIL), max(0, size - TAIL))
    at = tail.rfind(b"PK\5\6")
    if at < 0 or len(tail) - at < 22:
        raise NotAnArchive("no end of a central directory")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if n == _MAX16 or length == _MAX32 or start == _MAX32:
        if tail[at - 20 : at - 16] != b"PK\6\7":
            raise NotAnArchive("no ZIP64 locator")
        (place,) = struct.unpack_from("<Q", tail, at - 12)
        end = source.read_at(56, place)
        if end[:4] != b"PK\6\6":
            raise NotAnArchive("no ZIP64 end of the central directory")
        n, length, start = struct.unpack_from("<QQQ", end, 32)
    raw, at, members = source.read_at(length, start), 0, {}
    for _ in range(n):
        if raw[at : at + 4] != b"PK\1\2":
            raise NotAnArchive("the central directory is damaged")
        method = struct.unpack_from("<H", raw, at + 10)[0]
        packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", raw, at + 20)
        (header,) = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46 : at + 46 + names].decode("utf-8", "replace")
        extra = raw[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:  # what does not fit its field, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                plain = next(wide) if plain == _MAX32 else plain
                packed = next(wide) if packed == _MAX32 else packed
                header = next(wide) if header == _MAX32 else header
            extra = extra[4 + width :]
        members[name] = (method, packed, plain, header)
        at += 46 + names + extras + comment
    return members


def member_start(source, member: tuple[int, int, int, int]) -> int:
    """Where a stored member's data begins."""
    if member[0] != 0:
        raise NotAnArchive("the member is compressed")
    head = source.read_at(30, member[3])
    if head[:4] != b"PK\3\4":
        raise NotAnArchive("no local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member[3] + 30 + names + extras


def _open(address: str):
    files, path = fs.FileSystem.from_uri(address)
    return files.open_input_file(path)


def _index_rows(batches):
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            with _open(archive) as source:
                members = central_directory(source, source.size())
                base = member_start(source, members[RECORDS])
                start, left, rest = member_start(source, members[INDEX]), members[INDEX][2], b""
                while left:
                    part = source.read_at(min(left, 1 << 20), start)
                    start, left = start + len(part), left - len(part)
                    lines = (rest + part).split(b"\n")
                    rest = lines.pop()
                    places = [json.loads(x) for x in lines if x]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([archive] * len(places), pa.string()),
                            pa.array([base + p["offset"] for p in places], pa.int64()),
                            pa.array([p["length"] for p in places], pa.int64()),
                        ],
                        ["archive", "offset", "length"],
                    )


def parse_record(packed: bytes) -> dict:
    """Headers and payload of a record that is compressed by itself."""
    raw = zlib.decompress(packed, 31)
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = body[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers | {"payload": payload}


def _page(urn: str) -> str | None:
    return unquote(urn.removeprefix("<urn:page:").removesuffix(">")) or None


def _record_rows(batches, html: bool):
    for batch in batches:
        out = {k: [] for k in ("page", "url", "payload_bytes", "payload_digest", "record_type", "refers")}
        out |= {"html": []} if html else {}
        source, last = None, None
        for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            if archive != last:
                source, last = _open(archive), archive
            found = parse_record(source.read_at(length, offset))
            kind, payload = found["WARC-Type"], found["payload"]
            stated = found["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and digest(payload) != stated:
                raise NotAnArchive(f"{archive} at {offset}: the payload does not have its digest")
            out["page"].append(_page(found["WARC-Record-ID"]))
            out["url"].append(found["WARC-Target-URI"])
            out["payload_bytes"].append(len(payload) if kind == "response" else int(found["WARC-Payload-Length"]))
            out["payload_digest"].append(stated)
            out["record_type"].append(kind)
            out["refers"].append(_page(found["WARC-Refers-To"]) if kind == "revisit" else None)
            if html:
                out["html"].append(payload.decode("utf-8", "replace") if kind == "response" else None)
        kinds = {"payload_bytes": pa.int64()}
        arrays = [pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()]
        yield pa.RecordBatch.from_arrays(arrays, list(out))


def read_archives(archives: DataFrame, id_type: str = "long", html: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, html]) of every record.

    ``archives`` has a column ``archive``.  Only the directory, the index and the
    records' own bytes are read; responses are checked against their digest.  A
    revisit gives length and digest of the payload that it does not hold.
    """
    places = archives.select("archive").mapInArrow(_index_rows, "archive string, offset long, length long")
    # Neighbouring records stay together; archives of any length are read by many tasks.
    spread = places.repartition("archive", F.expr("offset div 8388608")).sortWithinPartitions("archive", "offset")
    schema = "page string, url string, payload_bytes long, payload_digest string, record_type string, refers string"
    rows = spread.mapInArrow(lambda b: _record_rows(b, html), schema + (", html string" if html else ""))
    return rows.select(
        F.col("page").cast(id_type).alias("page_id"),
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(id_type).alias("refers_to"),
        *(["html"] if html else []),
    )
