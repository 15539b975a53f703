import hashlib
import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticket_topics.llm import warc as W
from ticket_topics.session import scratch_path

PAGES = "page_id bigint, url string, html string"
BIG = "é" * 600  # 1200 bytes

ROWS = [
    (1, "http://a/", BIG), (2, "http://b/", BIG), (9, None, BIG), (3, "http://c/", "small"),
    (4, "http://d/", "small"), (5, "http://e/\r\nX: y", None), (6, "", ""), (None, "http://n/", BIG),
    (7, "http://ü/", "x" * 999), (8, "http://f/", "x" * 999), (10, "http://g/", "y" * 1000),
    (11, "http://h/", "y" * 1000), (12, "http://i/", "z" * 300_000 + "\r\n\r\n"),
    (None, "http://m/", "only" * 300), (None, "http://o/", "only" * 300),
]


def brute(rows):
    largest, out = {}, []
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    for i, _, html in rows:
        data = (html or "").encode()
        keep = largest.get(html or "")
        revisit = len(data) >= 1000 and keep is not None and i != keep
        kind = "revisit" if revisit else "response"
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), kind, keep if revisit else None))
    return sorted(out, key=repr)


def got(df):
    fields = ("id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[f] for f in fields) for r in df.collect()), key=repr)


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3)
    extra = df.select("*", *[F.lit("x").alias(n) for n in ("id", "payload", "digest", "keep", "path")])
    for frame in (df, extra):
        assert got(W.archive_round_trip(frame)) == brute(ROWS)
    assert W.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_come_back(spark):
    df = spark.createDataFrame(ROWS, PAGES)
    manifest = W.write_archives(df, scratch_path(spark, "warc"), archive_bytes=2000)
    assert manifest.count() > 1
    rows = W.read_archives(manifest).collect()
    back = {r.id: bytes(r.payload).decode() for r in rows if r.record_type == "response" and r.id}
    assert back == {str(i): h or "" for i, _, h in ROWS if i in (3, 4, 5, 6, 7, 8, 9, 11, 12)}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert {r.url for r in rows if r.id == "5"} == {"http://e/%0D%0AX:%20y"}


def test_directories(tmp_path):
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_STORED) as out:
        out.writestr(W.DATA_MEMBER, b"abc" * 100)
        out.writestr(W.INDEX_MEMBER, b"index")
        out.comment = b"PK\x05\x06 a comment that looks like the end"
    data = plain.getvalue()
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    members = W.central_directory(file, len(data))
    at, size = W.member_place(file, members, W.DATA_MEMBER)
    assert data[at : at + size] == b"abc" * 100
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr(W.DATA_MEMBER, b"abc" * 100)
    file = pa.PythonFile(io.BytesIO(packed.getvalue()), mode="r")
    members = W.central_directory(file, len(packed.getvalue()))
    for name in (W.DATA_MEMBER, "missing"):
        with pytest.raises(ValueError):
            W.member_place(file, members, name)
    with pytest.raises(ValueError):
        W.central_directory(pa.PythonFile(io.BytesIO(b"no zip" * 10), mode="r"), 60)


def test_zip64_directories(monkeypatch):
    # with the limits lowered the writer puts every size and place in ZIP64 fields
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("first", b"x" * 50)
        archive.writestr(W.DATA_MEMBER, b"abc" * 100)
        archive.writestr(W.INDEX_MEMBER, b"index of it")
    data = out.getvalue()
    assert W.END64 in data and W.END64_PLACE in data
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    members = W.central_directory(file, len(data))
    assert set(members) == {"first", W.DATA_MEMBER, W.INDEX_MEMBER}
    at, size = W.member_place(file, members, W.DATA_MEMBER)
    assert data[at : at + size] == b"abc" * 100


def test_a_damaged_record_is_refused():
    page = {"id": "1", "url": "u", "payload": b"some payload", "digest": "0" * 40, "refers_to": None}
    import gzip

    with pytest.raises(ValueError):
        W.parse_record(gzip.decompress(W.record_bytes(page)))
