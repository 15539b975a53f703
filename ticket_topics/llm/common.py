"""Helpers the operators share: names that cannot clash, batches bounded by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A batch of texts is worked on in slices of at most this many bytes (or one text).
SLICE_BYTES = 4 << 20


def text_of(text_col: str) -> Column:
    """The whole text; a null text is the empty text."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """The rows of ``docs`` whose id and digest are in ``kept`` (``id, digest``), one row
    for each such pair, with all their columns.

    The input row travels as one column, so that no name of it can clash. The key has no
    nulls, so the join and the reduction to one row share a single shuffle of the rows.
    """

    def key(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        key(F.col(f"`{id_col}`")).alias("key"),
        digest.alias("digest"),
    )
    wanted = kept.select(key(F.col("id")).alias("key"), "digest")
    found = rows.join(wanted, ["key", "digest"], "left_semi")
    return found.dropDuplicates(["key", "digest"]).select("doc.*")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text`` alone: other columns, whatever their names, are left behind.

    A null id stays null.
    """
    return df.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(texts: pa.Array) -> pa.Array:
    """A contiguous binary array of 64-bit offsets over UTF-8 texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_binary())


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` holds about SLICE_BYTES in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            end = max(end, begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def ragged_take(flat, starts, lengths, codes):
    """Concatenate ``flat[starts[c] : starts[c] + lengths[c]]`` for every code."""
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts[codes] - (ends - sizes), sizes)
    return flat[np.arange(total) + shift], sizes
