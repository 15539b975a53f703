"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition writes one sorted run of digests. In each round the runs of
``FAN_IN`` neighbours are exchanged, merged by digest and reduced to the smallest
verified identifier; after log(partitions) rounds one run per digest range is left.
Digest ranges keep the last rounds as wide as the first: no task ever holds more
than its range, and copies of one text cost one row per run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, skew_join
from ..session import staged
from .common import keep_rows, keyed_texts, text_of

FAN_IN_BITS = 3  # eight runs meet in a merge
RANGE_DIGITS = 4  # hexadecimal digits of the digest that name a range

SAME = ("digest", "check", "size")


def normalised(text):
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored ``row, id, digest, check, size``: one row per input row.

    ``row`` tells repeated rows apart; its upper half names the input partition.
    """
    texts = keyed_texts(docs, id_col, text_col).select("id", normalised("text").alias("text"))
    rows = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.xxhash64("text").alias("check"),
        F.octet_length("text").alias("size"),
    )
    return staged(rows, "digests")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce sorted rows to the first of each group of equal texts.

    Rows come by range, run, digest, check, size, id, row, so the first of a group
    has the smallest identifier; the second digest and the length verify that the
    texts are equal. Only the last row waits for the next batch.
    """
    keys = ("run", *SAME)
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
        if carry is not None:
            rows = pa.concat_batches([carry, rows])
        first = np.zeros(rows.num_rows, dtype=bool)
        first[0] = True
        for key in keys:
            column = rows.column(key)
            changed = pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1))
            first[1:] |= changed.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(first)
        sizes = np.add.reduceat(rows.column("n").to_numpy(), starts)
        merged = rows.drop_columns(["n"]).take(pa.array(starts))
        merged = merged.append_column("n", pa.array(sizes, pa.int64()))
        if merged.num_rows > 1:
            yield merged.slice(0, merged.num_rows - 1)
        carry = merged.slice(merged.num_rows - 1)
    if carry is not None:
        yield carry


def merge_runs(rows: DataFrame) -> DataFrame:
    """``digest, check, size, id, row, n`` of the smallest row of each distinct text."""
    order = ["part", "run", *SAME, F.col("id").asc_nulls_last(), "row"]
    runs = rows.select(
        F.substring(F.hex("digest"), 1, RANGE_DIGITS).alias("part"),
        F.shiftright("row", 33).cast("int").alias("run"),
        *SAME,
        "id",
        "row",
        F.lit(1).cast("long").alias("n"),
    )
    last = rows.agg(F.max(F.shiftright("row", 33))).first()[0] or 0
    rounds = max(1, math.ceil(math.log2(last + 1) / FAN_IN_BITS))
    # the first merge happens where the rows lie
    merged = runs.sortWithinPartitions(*order).mapInArrow(_merge, runs.schema)
    for _ in range(rounds):
        merged = (
            merged.withColumn("run", F.shiftright("run", FAN_IN_BITS))
            .repartition("part", "run")
            .sortWithinPartitions(*order)
            .mapInArrow(_merge, runs.schema)
        )
    return merged.drop("part", "run")


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest``.

    Texts are equal when identical after white-space runs became one space; a null
    text is empty. Of equal texts the row with the smallest id stays (null ids come
    last); of rows that repeat an id as well, one stays. An empty table gives no
    rows, other columns play no part.
    """
    rows = digest_rows(docs, id_col, text_col)
    groups = staged(merge_runs(rows), "digest-groups")
    keep = groups.select(
        "digest",
        F.col("id").alias("keep_id"),
        F.col("row").alias("keep_row"),
        F.col("n").alias("group_size"),
    )
    hot = hot_keys(groups, "digest")
    joined = skew_join(rows, keep, "digest", hot, "inner")
    return joined.select(
        "id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "digest",
    )


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows of one id whose texts differ are told apart by the digest; of rows equal
    in both one stays.
    """
    kept = duplicate_groups(docs, id_col, text_col).where("kept")
    digest = F.unhex(F.sha2(normalised(text_of(text_col)), 256))
    return keep_rows(docs, kept, id_col, digest)
