"""WARC records in ZIP-packaged archives, written and range-read without extraction.

An archive is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member per record, and ``indexes/index.cdxj``, one line per record with its
offset and length. The reader fetches the end of the file, the central directory
(32-bit or ZIP64), the index, and then the records in ranges; nothing is unpacked to
disk. Files are reached through ``pyarrow.fs``, so a folder may be local or in a store.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import scratch_path, staged
from .common import slices, text_of

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20  # an archive is closed beyond this size
RANGE_BYTES = 8 << 20  # records are fetched in ranges of about this size
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
WARC_DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Signatures and marks of the ZIP format.
END, END64, END64_PLACE = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
IN_EXTRA_16, IN_EXTRA_32, ZIP64_EXTRA, STORED = 0xFFFF, 0xFFFFFFFF, 1, 0


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


# --- writing


class _Stream:
    """The part of a file that a ZIP writer needs when it cannot seek."""

    def __init__(self, out):
        self.out, self.size = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def record_bytes(page: dict) -> bytes:
    """One gzip member: a response with the payload, or a revisit without it."""
    payload, refers_to = page["payload"], page["refers_to"]
    record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page['id']}")
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", page["url"] or "")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{page['digest']}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page["id"] is not None:
        head.append(f"WARC-Page-ID: {page['id']}")
    if refers_to is not None:
        target = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers_to}")
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{target}>",
            f"WARC-Refers-To-Page-ID: {refers_to}",
        ]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


def _write_archive(folder: str, pages: Iterator[dict], limit: int) -> tuple[str, int]:
    """Write pages until the archive has ``limit`` bytes; its path and record count.

    Every attempt writes a file of its own; the manifest names those that count.
    """
    files, base = open_folder(folder)
    path, lines = f"{base}/{uuid.uuid4().hex}.wacz", []
    with files.open_output_stream(path) as out:
        stream = _Stream(out)
        with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as archive:
            offset = 0
            with archive.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True) as member:
                for page in pages:
                    record = record_bytes(page)
                    member.write(record)
                    where = {"offset": offset, "length": len(record), "digest": page["digest"]}
                    lines.append(f"page:{page['id']} {WARC_DATE} {json.dumps(where)}\n")
                    offset += len(record)
                    if offset >= limit:
                        break
            archive.writestr(zipfile.ZipInfo(INDEX_MEMBER), "".join(lines))
    return path, len(lines)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Stored manifest ``path, records`` of the archives that hold all pages.

    Of records with equal payloads of at least ``min_revisit_bytes`` the one with the
    largest id is the response and the others revisit it; rows that tie on the largest
    id, and payloads whose ids are all null, are responses. A null payload is empty. An
    empty table writes no archive; other columns play no part.
    """
    payload = text_of(payload_col).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    repeated = staged(
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND keep IS NOT NULL")
        .select("digest", "keep"),
        "repeated-payloads",
    )
    joined = lookup_join(rows, repeated, "digest", "left")
    revisits = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    records = joined.select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        "digest",
        F.when(revisits, F.col("keep").cast("string")).alias("refers_to"),
    )
    open_folder(folder)[0].create_dir(open_folder(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = (page for batch in slices(batches, "payload") for page in batch.to_pylist())
        for first in queue:
            path, n = _write_archive(folder, _chain(first, queue), archive_bytes)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return staged(records.mapInArrow(run, "path string, records bigint"), "warc-manifest")


def _chain(first, rest):
    yield first
    yield from rest


# --- reading


def central_directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """``name: (method, stored size, place of the local header)`` of each member."""
    tail_at = max(0, size - (22 + 0xFFFF + 20))
    tail = _range(file, tail_at, size - tail_at)
    end = tail.rfind(END)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END, 0, end)
    if end < 0:
        raise ValueError("no ZIP directory at the end of the file")
    entries, length, place = struct.unpack_from("<H2I", tail, end + 10)
    if entries == IN_EXTRA_16 or IN_EXTRA_32 in (length, place):
        if tail[end - 20 : end - 16] != END64_PLACE:
            raise ValueError("the ZIP64 directory has no locator")
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        record = _range(file, at, 56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 locator leads elsewhere")
        entries, length, place = struct.unpack_from("<3Q", record, 32)
    directory, members, at = _range(file, place, length), {}, 0
    for _ in range(entries):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("the ZIP directory is damaged")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full = struct.unpack_from("<2I", directory, at + 20)
        name_size, extra_size, note_size = struct.unpack_from("<3H", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8", "replace")
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        # the ZIP64 extra field holds, in this order, the values that did not fit
        wide = iter(_zip64_values(extra))
        full = next(wide) if full == IN_EXTRA_32 else full
        packed = next(wide) if packed == IN_EXTRA_32 else packed
        header = next(wide) if header == IN_EXTRA_32 else header
        members[name] = (method, packed, header)
        at += 46 + name_size + extra_size + note_size
    return members


def _zip64_values(extra: bytes) -> tuple[int, ...]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_EXTRA:
            return struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
        at += 4 + size
    return ()


def member_place(file, members: dict, name: str) -> tuple[int, int]:
    """First byte and size of a stored member's data."""
    if name not in members:
        raise ValueError(f"the archive has no {name}")
    method, size, header = members[name]
    if method != STORED:
        raise ValueError(f"{name} is compressed and cannot be read in ranges")
    local = _range(file, header, 30)
    if local[:4] != LOCAL:
        raise ValueError(f"{name} has no local header")
    name_size, extra_size = struct.unpack_from("<2H", local, 26)
    return header + 30 + name_size + extra_size, size


def _range(file, at: int, size: int) -> bytes:
    data = file.read_at(size, at)
    if len(data) != size:
        raise ValueError("the file ends too early")
    return data


def parse_record(raw: bytes) -> dict:
    """One unpacked record; the payload of a response is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"record {fields['warc-record-id']} does not match its digest")
    return {
        "id": fields.get("warc-page-id"),
        "url": fields["warc-target-uri"],
        "record_type": kind,
        "refers_to": fields.get("warc-refers-to-page-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def record_ranges(manifest: DataFrame) -> DataFrame:
    """``path, start, lengths``: whole neighbouring records of about RANGE_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, place = open_folder(path)
                with files.open_input_file(place) as file:
                    members = central_directory(file, file.size())
                    data_at, _ = member_place(file, members, DATA_MEMBER)
                    lines = _range(file, *member_place(file, members, INDEX_MEMBER)).splitlines()
                entries = sorted(
                    (e["offset"], e["length"])
                    for e in (json.loads(line.split(b" ", 2)[2]) for line in lines)
                )
                found, start, lengths = [], 0, []
                for offset, length in entries:
                    if lengths and (
                        offset != start + sum(lengths) or sum(lengths) + length > RANGE_BYTES
                    ):
                        found.append((data_at + start, lengths))
                        lengths = []
                    start = start if lengths else offset
                    lengths.append(length)
                if lengths:
                    found.append((data_at + start, lengths))
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [path] * len(found),
                        "start": pa.array([f[0] for f in found], pa.int64()),
                        "lengths": pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    }
                )

    spread = manifest.select("path").repartition(max(1, manifest.count()))
    return staged(
        spread.mapInArrow(run, "path string, start bigint, lengths array<bigint>"), "warc-ranges"
    )


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """``id, url, record_type, refers_to, payload_bytes, payload_digest`` (all texts but
    the size) and, unless refused, ``payload`` (binary, null for a revisit) of every record.

    Digest and size of a revisit are those of the payload it refers to.
    """
    ranges = record_ranges(manifest)
    names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
    if payloads:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, place = open_folder(row["path"])
                with files.open_input_file(place) as file:
                    raw = _range(file, row["start"], sum(row["lengths"]))
                records, at = [], 0
                for length in row["lengths"]:
                    records.append(parse_record(gzip.decompress(raw[at : at + length])))
                    at += length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[n] for r in records], kind)
                        for n, kind in zip(names, kinds, strict=True)
                    ],
                    names,
                )

    spread = ranges.repartition(max(1, ranges.count()))
    schema = ", ".join(
        f"{n} {'bigint' if k == pa.int64() else 'binary' if k == pa.binary() else 'string'}"
        for n, k in zip(names, kinds, strict=True)
    )
    return spread.mapInArrow(run, schema)


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", folder: str | None = None, **columns
) -> DataFrame:
    """Write every page, read every record back; ids have the type they came with."""
    kind = pages.schema[id_col].dataType
    folder = folder or scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, id_col, **columns)
    records = read_archives(manifest, payloads=False)
    return records.withColumns(
        {c: F.col(c).cast(kind) for c in ("id", "refers_to")}
    )
