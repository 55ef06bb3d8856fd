"""Web archives inside ZIP packages: written by tasks, read by ranges through the ZIP directory and the package's index."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm import files
from scorespark.llm.blocks import slices
from scorespark.session import materialize

ARCHIVE, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
PACKAGE_BYTES = 256 << 20
READ_BYTES = 4 << 20
LEVEL = 1
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
NAME = "urn:x-page:"

# Fixed values of the ZIP format: signatures and records.
END, END64, LOCATOR64, ENTRY, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
END_RECORD = struct.Struct("<IHHHHIIH")
END64_RECORD = struct.Struct("<IQHHIIQQQQ")
LOCATOR_RECORD = struct.Struct("<IIQI")
ENTRY_RECORD = struct.Struct("<IHHHHHHIIIHHHHHII")
LOCAL_RECORD = struct.Struct("<IHHHHHIIIHH")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


ReadAt = Callable[[int, int], bytes]


def directory(read_at: ReadAt, size: int) -> list[Member]:
    """The members of a ZIP file of ``size`` bytes, from its end record, ZIP64 records and central directory."""
    tail_at = max(0, size - END_RECORD.size - FULL16)
    tail = read_at(tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    while at >= 0 and (len(tail) - at < END_RECORD.size or END_RECORD.unpack_from(tail, at)[-1] != len(tail) - at - END_RECORD.size):
        at = tail.rfind(struct.pack("<I", END), 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    *_, count, length, start, _ = END_RECORD.unpack_from(tail, at)
    place = tail_at + at - LOCATOR_RECORD.size
    locator = LOCATOR_RECORD.unpack(read_at(place, LOCATOR_RECORD.size)) if place >= 0 else (0,)
    if locator[0] == LOCATOR64:
        record = END64_RECORD.unpack(read_at(locator[2], END64_RECORD.size))
        if record[0] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = record[-3:]
    raw, at, members = read_at(start, length), 0, []
    for _ in range(count):
        (sign, _, _, flags, method, _, _, _, packed, full, name_len, extra_len, note_len, _, _, _, header) = ENTRY_RECORD.unpack_from(raw, at)
        if sign != ENTRY:
            raise ValueError("broken ZIP directory")
        at += ENTRY_RECORD.size
        name = raw[at : at + name_len].decode("utf-8" if flags & 0x800 else "cp437")
        extra, at = raw[at + name_len : at + name_len + extra_len], at + name_len + extra_len + note_len
        full, packed, header = _wide(extra, full, packed, header)
        members.append(Member(name, method, full, packed, header))
    return members


def _wide(extra: bytes, *numbers: int) -> tuple[int, ...]:
    """``numbers`` with those that do not fit 32 bits taken from the ZIP64 extra field, in its order."""
    values, at = b"", 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = extra[at + 4 : at + 4 + length]
        at += 4 + length
    wide = iter(struct.unpack(f"<{len(values) // 8}Q", values[: len(values) // 8 * 8]))
    return tuple(next(wide) if n == FULL32 else n for n in numbers)


def data_start(read_at: ReadAt, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed, it cannot be read by ranges")
    fields = LOCAL_RECORD.unpack(read_at(member.header, LOCAL_RECORD.size))
    if fields[0] != LOCAL:
        raise ValueError("broken ZIP member")
    return member.header + LOCAL_RECORD.size + fields[-2] + fields[-1]


def base32_digest(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit has the HTTP head only."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{NAME}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{NAME}{refers_to}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(raw: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.strip().decode() for k, _, v in (line.partition(b":") for line in raw.split(b"\r\n")[1:])}


def parse_record(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, digest, type, refers_to) of an unpacked record; a response's digest comes from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = warc["warc-payload-digest"].removeprefix("sha1:")
    page_id, refers_to = _page(warc["warc-record-id"]), _page(warc.get("warc-refers-to", f"<{NAME}>"))
    if warc["warc-type"] == "revisit":
        return page_id, int(_headers(http)["content-length"]), stated, "revisit", refers_to
    digest = base32_digest(hashlib.sha1(payload).digest())
    if digest != stated:
        raise ValueError(f"payload of page {page_id} differs from its digest")
    return page_id, len(payload), digest, "response", None


def _page(name: str) -> int | None:
    number = name[1:-1].removeprefix(NAME)
    return int(number) if number else None


class PackageWriter:
    """A ZIP file with one stored archive, an index line per record, and a list of its contents."""

    def __init__(self, folder: str) -> None:
        system, path = files.open_folder(folder)
        self.name = files.own_name("wacz")
        self.stream = system.open_output_stream(f"{path}/{self.name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.archive = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, url: str | None, raw: bytes, digest: str) -> None:
        about = {"url": url or "", "digest": f"sha1:{digest}", "offset": self.at, "length": len(raw), "filename": ARCHIVE.rpartition("/")[2]}
        self.lines.append(json.dumps(about))
        self.archive.write(raw)
        self.at += len(raw)

    def close(self) -> str:
        self.archive.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.writestr(PACKAGE, json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": ARCHIVE, "bytes": self.at}, {"path": INDEX}]}))
        self.zip.close()
        self.stream.close()
        return self.name


def write_packages(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", package_bytes: int = PACKAGE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages``; returns the stored table (file, records).

    Of rows with equal payloads, those with the smallest id are responses and
    the others revisits of it.  Digests are grouped without the payloads; the
    payloads move only if the digests that occur twice are too many to send to
    every task, and then a digest of very many rows is split by the join.

    Null payloads are empty, null urls are left out; null ids come after all others and
    name nothing, so without another id each such row is a response.  Ids are integers.
    Rows that repeat the smallest id are all responses; other columns are not read; no rows
    give no package.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    marked = rows.join(materialize(firsts, "firsts"), "digest", "left")
    refers_to = F.when(F.coalesce(F.col("id") > F.col("first"), F.col("first").isNotNull()), F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, writer = [], None
        for block in slices(batches, "payload"):
            for page_id, url, text, digest, first in zip(*(c.to_pylist() for c in block.columns), strict=True):
                writer = writer or PackageWriter(folder)
                code = base32_digest(bytes.fromhex(digest))
                writer.add(url, record(page_id, url, text.encode(), code, first), code)
                if writer.at >= package_bytes:
                    done.append((writer.close(), len(writer.lines)))
                    writer = None
        if writer:
            done.append((writer.close(), len(writer.lines)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["file", "records"])

    ready = marked.select("id", "url", "payload", "digest", refers_to.alias("first"))
    return materialize(ready.mapInArrow(write, "file string, records long"), "packages")


def package_records(system, path: str) -> Iterator[tuple]:
    """The records of one package, by ranges of its archive that the index names; adjoining ones are read together."""
    with system.open_input_file(path) as f:
        read_at = lambda at, n: f.read_at(n, at)
        members = {m.name: m for m in directory(read_at, f.size())}
        start = data_start(read_at, members[ARCHIVE])
        index = members[INDEX]
        lines = read_at(data_start(read_at, index), index.size).decode().split("\n")
        ranges = [(about["offset"], about["length"]) for about in map(json.loads, filter(None, lines))]
        k = 0
        while k < len(ranges):
            low, j = ranges[k][0], k
            while j < len(ranges) and low <= ranges[j][0] and (j == k or sum(ranges[j]) - low <= READ_BYTES):
                j += 1
            raw = read_at(start + low, max(sum(r) for r in ranges[k:j]) - low)
            for at, n in ranges[k:j]:
                yield parse_record(zlib.decompress(raw[at - low : at - low + n], 31))
            k = j


def read_packages(manifest: DataFrame, folder: str, *, id_col: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every record of the listed packages."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = files.open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                for row in package_records(system, f"{path}/{name}"):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield made(rows)
                        rows = []
                yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        names = [id_col, "payload_bytes", "payload_digest", "record_type", "refers_to"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"`{id_col}` long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return manifest.select("file").repartition(max(1, manifest.count())).mapInArrow(read, schema)


def archived(pages: DataFrame, **names: str) -> DataFrame:
    """Write ``pages`` into packages in a new shared folder and read the records back; runs jobs while it is built."""
    folder = files.shared_folder(pages.sparkSession, "packages")
    manifest = write_packages(pages, folder, **names)
    return read_packages(manifest, folder, id_col=names.get("id_col", "page_id"))
