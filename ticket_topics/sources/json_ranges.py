"""JSON records of large files, found by byte range, with their file and offset.

A file of one JSON array, or of objects over several lines, cannot be cut at line ends.
Here the text source cuts it at closing braces instead, so any file system that Spark
reads will do and every range is read by a task of its own. A range does not know
whether it begins inside a string or how deep it lies, so it is read twice:

1. Each range reports, for both cases (outside and inside a string), how many quotes and
   braces it holds. Running sums over the ranges of a file give the state and the byte
   offset in which every range begins. A range begins behind a brace, so a backslash
   never reaches over its edge, and a brace is no part of a longer UTF-8 sign.
2. Each range, now knowing its state, gives back its whole records. A record that reaches
   over the edge is given in parts, which are put together by the offset of its first.

What lies between records and is no comma or white space is a record too, a malformed
one, as is a record that the file breaks off: nothing vanishes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

LAYOUTS = ("lines", "array")
CORRUPT = "corrupt_record"
QUOTE, BACKSLASH = ord('"'), ord("\\")
STEP = np.zeros(256, dtype=np.int64)
STEP[[ord("{"), ord("[")]] = 1
STEP[[ord("}"), ord("]")]] = -1
BETWEEN = b" \t\r\n,[]"
FIELDS = "file string, block bigint"
SUMMARY = f"{FIELDS}, size bigint, bytes bigint, quotes bigint, outside bigint, inside bigint, first string"
PARTS = f"{FIELDS}, offset bigint, part string, text binary"


def brackets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of braces and brackets, their steps of depth, the parity of quotes before
    them, and the number of quotes; escaped quotes are none. ``data`` begins unescaped."""
    quotes = np.flatnonzero(data == QUOTE)
    slash = data == BACKSLASH
    if len(quotes) and slash.any():
        last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        before = quotes - 1
        run = np.where(before >= 0, before - last[before], 0)
        quotes = quotes[run % 2 == 0]
    at = np.flatnonzero(STEP[data])
    return at, STEP[data[at]], np.searchsorted(quotes, at) % 2, len(quotes)


def _batches(batches: Iterator[pa.RecordBatch]):
    """``file, block, size, bytes`` of runs of pieces of one range, braces put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        sizes, pieces = batch.column("size").to_pylist(), batch.column("piece").to_pylist()
        begin = 0
        for i in range(1, len(pieces) + 1):
            if i == len(pieces) or (files[i], blocks[i]) != (files[begin], blocks[begin]):
                yield files[begin], blocks[begin], sizes[begin], b"}".join(pieces[begin:i]) + b"}"
                begin = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: list | None = None
    for file, block, size, data in _batches(batches):
        if now is None or now[:2] != [file, block]:
            if now is not None:
                yield _row(now)
            now = [file, block, size, 0, 0, 0, 0, None]
        _, steps, odd, quotes = brackets(np.frombuffer(data, dtype=np.uint8))
        sums = [int(steps[odd == k].sum()) for k in (0, 1)]
        # what lay outside before an odd number of quotes lies inside behind it
        if now[4] % 2:
            sums.reverse()
        if now[7] is None and (head := data.lstrip(b" \t\r\n")):
            now[7] = chr(head[0])
        now[3] += len(data)
        now[4] += quotes
        now[5] += sums[0]
        now[6] += sums[1]
    if now is not None:
        yield _row(now)


def _row(values: list) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string()]
    names = [field.split()[0] for field in SUMMARY.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names
    )


@dataclass
class Range:
    """A range being read: where it stands and the record that is open."""

    file: str
    block: int
    at: int
    depth: int
    inside: bool
    base: int
    cut: bool | None

    def __post_init__(self):
        self.begun_before = self.depth > self.base
        self.open: list[bytes] = []
        self.opened = self.at
        self.rows: list[tuple] = []

    def give(self, offset: int, part: str, text: bytes) -> None:
        self.rows.append((self.file, self.block, offset, part, text))

    def read(self, data: bytes) -> None:
        if not data:
            return
        at, steps, odd, quotes = brackets(np.frombuffer(data, dtype=np.uint8))
        outside = (odd == 1) if self.inside else (odd == 0)
        at, steps = at[outside], steps[outside]
        after = self.depth + np.cumsum(steps)
        edge = np.flatnonzero((after - steps == self.base) & (steps > 0) | (after == self.base) & (steps < 0))
        done = 0
        for place, step in zip(at[edge].tolist(), steps[edge].tolist(), strict=True):
            if step > 0:
                self.between(data[done:place], done)
                self.opened, done = self.at + place, place
            else:
                self.open.append(data[done : place + 1])
                self.close("tail" if self.begun_before else "whole")
                done = place + 1
        self.depth = int(after[-1]) if len(after) else self.depth
        self.inside ^= bool(quotes % 2)
        if self.depth > self.base:
            self.open.append(data[done:])
        else:
            self.between(data[done:], done)
        self.at += len(data)

    def between(self, gap: bytes, done: int) -> None:
        """Anything but commas and white space between records is malformed."""
        if gap.translate(None, BETWEEN):
            begin = len(gap) - len(gap.lstrip(BETWEEN))
            self.give(self.at + done + begin, "whole", gap.strip(BETWEEN))

    def close(self, part: str) -> None:
        self.give(self.opened, part, b"".join(self.open))
        self.open, self.begun_before = [], False

    def end(self) -> None:
        """The part of a record that reaches over the end of the range."""
        if self.open:
            self.close("middle" if self.begun_before else "head")

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 5
        self.rows = []
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["file", "block", "offset", "part", "text"],
        )


def _parts(shared):
    """Whole records and parts of records of every range, in order; ``shared`` is a
    broadcast of the state each range begins in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Range | None = None
        held = b""
        for file, block, _, data in _batches(batches):
            if now is None or (now.file, now.block) != (file, block):
                if now is not None:
                    yield _finished(now, held)
                now, held = Range(file, block, *shared.value[file, block]), b""
            now.read(held)
            held = data
            if now.rows:
                yield now.flush()
        if now is not None:
            yield _finished(now, held)

    return run


def _finished(now: Range, held: bytes) -> pa.RecordBatch:
    # The last piece of a file need not end with a brace. Of a compressed file it is not
    # known whether it does; there the brace counts if a record is open.
    now.read(held if now.cut is False else held[:-1])
    if now.cut is None and now.depth > now.base:
        now.read(b"}")
    now.end()
    return now.flush()


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return (
        spark.read.option("lineSep", separator)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            F.col("value").cast("binary").alias("piece"),
        )
    )


def range_states(pieces: DataFrame) -> DataFrame:
    """``file, block, at, depth, inside, base, cut``: one small row for each range."""
    ordered = Window.partitionBy("file").orderBy("block")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    zero = F.lit(0).cast("bigint")
    inside = F.coalesce(F.sum("quotes").over(earlier), zero) % 2 == 1
    found = staged(pieces.mapInArrow(_summaries, SUMMARY), "json-ranges")
    known = found.withColumn("in", inside).withColumn("step", F.when(F.col("in"), F.col("inside")).otherwise(F.col("outside")))
    array = F.first("first", ignorenulls=True).over(whole) == "["
    # one more byte than there are: a brace was put behind the end (a mark of the byte
    # order, three bytes, is left out by the reader)
    surplus = F.sum("bytes").over(whole) - F.col("size")
    last = F.col("block") == F.max("block").over(whole)
    cut = F.when(~last | surplus.isin(0, -3), False).when(surplus.isin(1, -2), True)
    return known.select(
        "file",
        "block",
        F.coalesce(F.sum("bytes").over(earlier), zero).alias("at"),
        F.coalesce(F.sum("step").over(earlier), zero).alias("depth"),
        F.col("in").alias("inside"),
        F.coalesce(array, F.lit(False)).cast("bigint").alias("base"),
        cut.alias("cut"),
    )


def _array_records(spark: SparkSession, path: str) -> DataFrame:
    pieces = _pieces(spark, path, "}")
    # five numbers for every range, of some 100 MB each: a millionth of the data
    states = {
        (r.file, r.block): (r.at, r.depth, r.inside, r.base, r.cut)
        for r in range_states(pieces).toLocalIterator()
    }
    parts = pieces.mapInArrow(_parts(spark.sparkContext.broadcast(states)), PARTS)
    whole = parts.where("part = 'whole'").select("file", "offset", "text")
    edges = staged(parts.where("part <> 'whole'"), "json-edges")
    head = F.col("part") == "head"
    in_order = Window.partitionBy("file").orderBy("block", head)
    owned = edges.withColumn(
        "owner", F.last(F.when(head, F.col("offset")), ignorenulls=True).over(in_order)
    )
    joined = owned.groupBy("file", F.col("owner").alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    text = F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["text"]))
    return whole.unionByName(joined.select("file", "offset", text.alias("text")))


def _line_offsets(shared):
    """The lines and the bytes they begin at; the lines stay in Arrow, and only their
    lengths are looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.asarray(pc.binary_length(batch.column("piece")), dtype=np.int64) + 1
            ends = np.cumsum(sizes)
            offsets = ends - sizes
            files = batch.column("file").dictionary_encode()
            codes, blocks = np.asarray(files.indices), np.asarray(batch.column("block"))
            changes = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
            cuts = [0, *changes.tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                place = (files.dictionary[int(codes[begin])].as_py(), int(blocks[begin]))
                if place != here:
                    here, at = place, shared.value[place]
                first = int(ends[begin] - sizes[begin])
                offsets[begin:end] += at - first
                at += int(ends[end - 1]) - first
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), pa.array(offsets, pa.int64()), batch.column("piece")],
                ["file", "offset", "text"],
            )

    return run


def _line_records(spark: SparkSession, path: str) -> DataFrame:
    pieces = _pieces(spark, path, "\n")
    sizes = pieces.groupBy("file", "block").agg(F.sum(F.octet_length("piece") + 1).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("at")
    starts = {
        (r.file, r.block): r.at
        for r in sizes.select("file", "block", at).toLocalIterator()
    }
    shared = spark.sparkContext.broadcast(starts)
    return pieces.mapInArrow(_line_offsets(shared), "file string, offset bigint, text binary")


def json_records(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """``file, offset, record``: the text of every JSON record and the byte it begins at.

    ``layout`` is lines (a record in each line) or array (one array of objects, or objects
    over any number of lines, one after the other). Blank lines are no records. A file is
    read in ranges of ``spark.sql.files.maxPartitionBytes``; a compressed one in one. The
    files must not change while they are read. A byte order mark does not count.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {LAYOUTS}")
    found = _line_records(spark, path) if layout == "lines" else _array_records(spark, path)
    text = F.col("text").cast("string")
    rows = found.select("file", "offset", F.rtrim(text, F.lit("\r")) if layout == "lines" else text)
    rows = rows.toDF("file", "offset", "record")
    return rows.where(F.trim(F.col("record"), F.lit(" \t\r\n")) != "")


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, layout: str = "lines"
) -> DataFrame:
    """``file, offset``, the fields of ``schema`` and ``corrupt_record``.

    A malformed record has its whole text in ``corrupt_record``; nothing is left out. A
    line may hold an array of records, which are given one by one at the line's offset.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    records = json_records(spark, path, layout)
    text = F.col("record")
    one = F.from_json(text, full, options)
    if layout == "array":
        return records.select("file", "offset", one.alias("row")).select("file", "offset", "row.*")
    lost = F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], text.alias(CORRUPT)
    )
    many = F.coalesce(F.from_json(text, T.ArrayType(full), options), F.array(lost))
    rows = F.when(F.ltrim(text).startswith("["), many).otherwise(F.array(one))
    return records.select("file", "offset", F.explode(rows).alias("row")).select(
        "file", "offset", "row.*"
    )


def write_json_arrays(df: DataFrame, path: str, indent: bool = True) -> None:
    """Every partition as one file that holds one JSON array of its rows.

    Null fields are written, each record over several lines if ``indent``. A partition
    without rows gives an empty array.
    """
    options = {"ignoreNullFields": "false", "pretty": str(indent).lower()}
    records = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            texts = []
            for text in batch.column("value").to_pylist():
                texts.append(f"{before}{text}")
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"])], ["value"])

    records.mapInArrow(run, "value string").write.text(path)
