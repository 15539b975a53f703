"""JSON records by byte ranges against Spark's own reader and Python's."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from ticket_topics.operators.quality import malformed, without_malformed
from ticket_topics.schema import RAW_COMPLAINT
from ticket_topics.sources import complaints, json_ranges

SCHEMA = "a string, n bigint, s struct<t: string, l: array<string>>"
SIGNS = ['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "é", "日本", "\U0001f600", "x", " ", "\\\\", '\\"', "}{", '"}']


def struct():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(SCHEMA)


def made_up(seed, n):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(SIGNS) for _ in range(rng.choice([0, 1, 3, 9, 60])))

    return [
        {"a": text() or None, "n": i, "s": {"t": text(), "l": [text() for _ in range(i % 4)]}}
        for i in range(n)
    ]


def rows_of(df):
    return sorted((r["n"], r["a"], r["s"]["t"], tuple(r["s"]["l"])) for r in df.collect())


def expected(records):
    return sorted((r["n"], r["a"], r["s"]["t"], tuple(r["s"]["l"])) for r in records)


@pytest.fixture
def ranges(spark):
    """Cut files at every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [97, 1000])
@pytest.mark.parametrize("style", ["pretty", "one line", "objects", "signs kept"])
def test_any_cut_gives_the_rows_of_the_whole(spark, tmp_path, ranges, size, style):
    records = made_up(size, 12)
    body = {
        "pretty": json.dumps(records, indent=2),
        "one line": json.dumps(records) + "\n",
        "objects": "\n\n".join(json.dumps(r, indent=1) for r in records),
        "signs kept": "  " + json.dumps(records, indent=2, ensure_ascii=False) + " \n ",
    }[style]
    path = tmp_path / "big.json"
    path.write_text(body)
    ranges(size)
    found = json_ranges.read_json_records(spark, str(path), struct(), "array")
    if size == 97:
        assert found.rdd.getNumPartitions() > 10
    assert rows_of(found) == expected(records)
    data = path.read_bytes()
    for row in json_ranges.json_records(spark, str(path), "array").collect():
        text = row["record"].encode()
        assert data[row["offset"] : row["offset"] + len(text)] == text
    if style in ("pretty", "signs kept"):
        plain = spark.read.schema(SCHEMA).option("multiLine", True).json(str(path))
        assert rows_of(found) == rows_of(plain)


def test_several_files_and_compressed_ones(spark, tmp_path, ranges):
    records = made_up(3, 16)
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps(records[k * 4 : k * 4 + 4], indent=k))
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(json.dumps(records[12:]).encode()))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "blank.json").write_text(" [\n]\n")
    ranges(200)
    found = json_ranges.read_json_records(spark, str(tmp_path), struct(), "array")
    assert rows_of(found) == expected(records)


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_malformed_parts_of_an_array_are_kept(spark, tmp_path, ranges, size):
    path = tmp_path / "bad.json"
    path.write_text('[{"n": 1}, oops, {"n": x}, {"n": 2}, 7, {"n": 3, "s": {"t": "}"}')
    ranges(size)
    found = json_ranges.read_json_records(spark, str(path), struct(), "array").collect()
    assert sorted(r["n"] for r in found if r["n"] is not None and not r["corrupt_record"]) == [1, 2]
    bad = sorted((r["offset"], r["corrupt_record"]) for r in found if r["corrupt_record"])
    assert bad[-1][1] == '{"n": 3, "s": {"t": "}"}'
    assert [b[1] for b in bad[:-1]] == ["oops", '{"n": x}', "7"]
    data = path.read_text()
    assert all(data[o : o + len(t)] == t for o, t in bad)


@pytest.mark.parametrize("size", [24, 1 << 20])
def test_lines_keep_what_is_malformed(spark, tmp_path, ranges, size):
    lines = ['{"n": 1}', "", '{"n": 2', '[{"n": 3}, {"n": 4}]', "  ", "[oops", "null", '{"n": 5}\r', "é", '{"n": "x"}']
    path = tmp_path / "lines.json"
    path.write_bytes("\n".join(lines).encode())
    ranges(size)
    found = json_ranges.read_json_records(spark, str(path), struct(), "lines").collect()
    good = sorted(r["n"] for r in found if not r["corrupt_record"] and r["n"] is not None)
    assert good == [1, 3, 4, 5]
    bad = {r["corrupt_record"]: r["offset"] for r in found if r["corrupt_record"]}
    assert {'{"n": 2', "[oops", "é", '{"n": "x"}'} <= set(bad)
    data = path.read_bytes()
    for text, offset in bad.items():
        assert data[offset : offset + len(text.encode())] == text.encode()
    assert len(found) == 9


def test_written_arrays_are_read_back(spark, tmp_path):
    df = spark.createDataFrame(made_up(8, 50), SCHEMA).repartition(3)
    for indent in (True, False):
        path = str(tmp_path / f"out{indent}")
        json_ranges.write_json_arrays(df, path, indent)
        for file in (tmp_path / f"out{indent}").glob("part-*"):
            json.loads(file.read_text())
        assert rows_of(json_ranges.read_json_records(spark, path, struct(), "array")) == rows_of(df)
    path = str(tmp_path / "no rows")
    json_ranges.write_json_arrays(df.limit(0), path)
    assert json_ranges.read_json_records(spark, path, struct(), "array").count() == 0


def test_complaints_of_several_lines_are_read_in_ranges(spark, tmp_path, ranges):
    rows = [{"_id": str(i), "_score": 1.5, "_source": {"state": "a}\"{" * i}} for i in range(12)]
    path = tmp_path / "raw.json"
    path.write_text(json.dumps(rows, indent=2))
    ranges(300)
    found = complaints.read_complaints(spark, str(path), multi_line=True)
    assert found.schema == RAW_COMPLAINT and found.rdd.getNumPartitions() > 3
    want = spark.read.schema(RAW_COMPLAINT).option("multiLine", True).json(str(path))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_malformed_records_go_to_the_quarantine(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text('{"_id": "1"}\n{"_id": "2"\n{"_id": "3"}\n')
    found = complaints.read_checked_complaints(spark, str(path))
    good, bad = without_malformed(found), malformed(found)
    assert [r["_id"] for r in good.orderBy("_id").collect()] == ["1", "3"]
    assert good.schema == RAW_COMPLAINT
    row = bad.first()
    assert (row["offset"], row["corrupt_record"], row["errors"]) == (13, '{"_id": "2"', ["malformed_json"])
    assert row["file"].endswith("raw.json") and bad.count() == 1


def test_layout_is_checked(spark):
    with pytest.raises(ValueError):
        json_ranges.json_records(spark, "x", "table")


def test_a_long_string_of_signs(spark, tmp_path, ranges):
    records = [{"a": "\\\"{}" * 2000, "n": 1, "s": {"t": "é" * 3000, "l": []}}] * 3
    path = tmp_path / "long.json"
    path.write_text(json.dumps(records, ensure_ascii=False))
    ranges(4096)
    found = json_ranges.read_json_records(spark, str(path), struct(), "array")
    assert rows_of(found) == expected(records)
    assert found.select(F.length("a")).distinct().count() == 1


def test_lines_stay_in_arrow():
    """Offsets of batches over two files and ranges, without a Python object for each line."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    lines = [b"x" * 1000] * 4000
    places = [("a", 0)] * 1000 + [("a", 50)] * 1500 + [("b", 0)] * 1500
    names = ["file", "block", "piece"]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in places[i:j]]), pa.array([b for _, b in places[i:j]], pa.int64()), pa.array(lines[i:j], pa.binary())],
            names,
        )
        for i, j in ((0, 0), (0, 1200), (1200, 4000))
    ]
    shared = SimpleNamespace(value={("a", 0): 0, ("a", 50): 7000, ("b", 0): 3})
    tracemalloc.start()
    found = list(json_ranges._line_offsets(shared)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    offsets = [o for b in found for o in b.column("offset").to_pylist()]
    starts = {("a", 0): 0, ("a", 50): 7000, ("b", 0): 3}
    want = []
    for place in places:
        want.append(starts[place])
        starts[place] += 1001
    assert offsets == want
    assert peak < 1 << 20
