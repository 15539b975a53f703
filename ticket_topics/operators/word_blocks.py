"""Lookups of the words of texts in dictionaries too large to broadcast.

Rows that follow one another are a block, which asks for each of its words once; what is
found goes back to the block, and the texts are worked on there. So no token is shuffled:
the rows are, once, and a word for each block that has it. The same holds of counted terms
(:func:`with_terms`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arrays import term_frequencies
from ..session import staged

BLOCK_BYTES = 1 << 23  # bytes of words, and rows, of a block, but for its last row
ADDED = ("_block", "_words")


def block_number(sizes: Column) -> Column:
    """Number of a block of rows that follow one another, by the bytes of each."""
    most = BLOCK_BYTES

    @F.arrow_udf("bigint")
    def numbered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number, held = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            size = np.asarray(batch, dtype=np.int64) + 1
            ends = held + np.cumsum(size)
            held = int(ends[-1]) if len(ends) else held
            yield pa.array(number + (ends - size) // most)

    return numbered(sizes)


def word_blocks(df: DataFrame, words: Column) -> DataFrame:
    """Stored rows with the number of their ``_block`` and ``_words``, joined by spaces.

    ``words`` is an array of words without spaces.
    """
    joined = df.withColumn("_words", F.array_join(words, " "))
    return staged(joined.withColumn("_block", block_number(F.octet_length("_words"))), "word-blocks")


def split_words(joined: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The words one after the other, and how many each text has; also of lists of words."""
    flat = joined.combine_chunks() if isinstance(joined, pa.ChunkedArray) else joined
    if pa.types.is_list(flat.type):
        lists = flat
    else:
        lists = pc.split_pattern(pc.if_else(pc.equal(flat, ""), pa.scalar(None, flat.type), flat), " ")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten(), lengths.astype(np.int64)


def asked_words(rows: DataFrame, key: str) -> DataFrame:
    """``_block, key``: the words of each block. A block that is read in two batches may
    ask twice."""

    def distinct(batches):
        for batch in batches:
            words, lengths = split_words(batch.column("_words"))
            coded = words.dictionary_encode()
            blocks, place = np.unique(np.asarray(batch.column("_block")), return_inverse=True)
            n = max(len(coded.dictionary), 1)
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = np.unique(np.repeat(place, lengths) * n + codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[pairs // n], pa.int64()), coded.dictionary.take(pa.array(pairs % n))],
                ["_block", key],
            )

    return rows.select("_block", "_words").mapInArrow(distinct, f"_block bigint, {key} string")


def with_found(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str | object,
) -> DataFrame:
    """``work(found, rows)`` on every block: the entries of its words and its rows.

    ``lookup`` has one row for each ``key``; words it lacks are not found. No word has
    more rows than there are blocks, so none is hot.
    """
    found = asked_words(rows, key).join(lookup.hint("merge"), key)
    return found.groupBy("_block").cogroup(rows.groupBy("_block")).applyInArrow(work, schema)


def found_places(found: pa.Table, key: str, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The coded words, and for each distinct one its row in ``found``, or -1."""
    coded = words.dictionary_encode()
    known = found.column(key).combine_chunks().dictionary_encode()
    # a block that asked twice has equal rows
    first = np.unique(known.indices.to_numpy(zero_copy_only=False), return_index=True)[1]
    at = pd.Index(known.dictionary.to_pandas()).get_indexer(coded.dictionary.to_pandas())
    return coded, np.where(at >= 0, first[at] if len(first) else -1, -1)


def counted_blocks(df: DataFrame, tokens: Column, text: str, *keep: str) -> DataFrame:
    """Stored ``keep``, a number ``_row``, the term frequencies ``_counts`` of the tokens and
    the number of the ``_block`` of each row."""
    number = F.monotonically_increasing_id().alias("_row")
    size = F.coalesce(F.octet_length(text), F.lit(0)).alias("_block")
    counted = df.select(*keep, number, term_frequencies(tokens).alias("_counts"), size)
    return staged(counted.withColumn("_block", block_number(F.col("_block"))), "counted-texts")


def with_terms(
    rows: DataFrame,
    terms: DataFrame,
    work: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray, int], list],
    keep: tuple[str, ...],
    schema: str,
) -> DataFrame:
    """``keep`` and columns of ``schema`` for all :func:`counted_blocks`.

    ``work`` gets the entries found in ``terms``, one row for each ``term``, and of the known
    terms of a block's rows their rows, their places in the entries and their frequencies,
    and the number of rows. No count of a term is shuffled, and nothing is broadcast.
    """

    def run(found: pa.Table, table: pa.Table) -> pa.Table:
        words, lengths = split_words(table.column("_words"))
        coded, at = found_places(found, "term", words)
        place = at[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        tf = table.column("_tf").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(table.num_rows), lengths)
        known = place >= 0
        more = work(found, owner[known], place[known], tf[known].astype(np.float64), table.num_rows)
        return pa.table([*[table.column(c) for c in keep], *more], names)

    added = StructType.fromDDL(schema)
    names = [*keep, *added.fieldNames()]
    counts = [F.col("_counts.term").alias("_words"), F.col("_counts.tf").alias("_tf")]
    kind = StructType([*[rows.schema[c] for c in keep], *added.fields])
    return with_found(rows.select("_block", *keep, *counts), terms, "term", run, kind)


def weighted_terms(rows: DataFrame, known: DataFrame, *keep: str) -> DataFrame:
    """``keep, j, x`` of every row of :func:`counted_blocks`: the numbers of its terms in
    ``known`` (``term_id, term, w``) and their frequencies times ``w``."""

    def listed(found, owner, place, tf, n):
        sizes = np.bincount(owner, minlength=n)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        j, w = (found.column(c).to_numpy() for c in ("term_id", "w"))
        return [
            pa.ListArray.from_arrays(offsets, pa.array(j[place].astype(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(tf * w[place])),
        ]

    entries = known.select("term_id", "term", "w")
    return with_terms(rows, entries, listed, keep, "j array<bigint>, x array<double>")
