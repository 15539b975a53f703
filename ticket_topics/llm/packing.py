"""Packing documents into token sequences by vector best-fit.

Every piece of a document demands tokens, one place among the documents of a sequence
and attention cost (its squared length). Pieces go in falling length to the open
sequence that holds them under every limit and is chosen by the weighted norm of what
would be left, or by the weighted dot product of demand and rest.

Texts are dealt evenly first, so that every window of pieces has the table's mix of
lengths in whatever order it lies. Each task packs windows as they are tokenised;
sequences that are all but full stay, the pieces of the others, a few per cent, are
gathered and packed again.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import staged
from .bpe import PieceIds, pieces_of
from .common import keyed_texts, shuffle_partitions, slices

WINDOW = 8192  # pieces packed at a time
CACHE_PIECES = 600_000  # text pieces a worker remembers before it starts anew


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence and how a place is chosen.

    ``documents`` and ``cost`` default to what the tokens allow anyway: as many
    documents as tokens, and the square of all tokens.
    """

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"

    def capacities(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.cost or self.tokens**2],
            dtype=np.int64,
        )


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece, and the tokens left in each bin.

    Equal lengths are placed in their order; of equally good bins the oldest is taken.
    A piece that alone exceeds a limit stands alone.
    """
    capacity = limits.capacities()
    weights = np.array(limits.weights) / capacity.astype(float) ** 2
    bins = np.empty(len(lengths), dtype=np.int64)
    left = np.empty(len(lengths), dtype=np.int64)
    used = 0
    # of the open bins, oldest first: number, and what is left of each capacity
    number = np.empty(len(lengths), dtype=np.int64)
    rest = np.empty((3, len(lengths)))
    n_open = 0
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths[order[-1]]) if len(order) else 0
    # a capacity as wide as the tokens allow can't bind before they do
    binds = [True, capacity[1] < capacity[0] or smallest < 1, capacity[2] < capacity[0] ** 2]
    for step, i in enumerate(order):
        length = int(lengths[i])
        demand = (length, 1, length * length)
        at = -1
        if n_open and length < limits.tokens:
            if step % 64 == 0:  # bins that no piece to come can enter are done
                now = np.flatnonzero((rest[0, :n_open] >= smallest) & (rest[1, :n_open] > 0))
                n_open = len(now)
                number[:n_open], rest[:, :n_open] = number[now], rest[:, now]
            value = np.zeros(n_open)
            for kind in range(3):
                if weights[kind] and limits.rule == "norm":
                    after = rest[kind, :n_open] - demand[kind]
                    after *= after
                    value += weights[kind] * after
                elif weights[kind]:
                    value -= weights[kind] * demand[kind] * rest[kind, :n_open]
            for kind in range(3):
                if binds[kind]:
                    value[rest[kind, :n_open] < demand[kind]] = np.inf
            if n_open:
                at = int(np.argmin(value))
                at = at if value[at] < np.inf else -1
        if at < 0:
            at, n_open = n_open, n_open + 1
            number[at], rest[:, at], left[used] = used, capacity, limits.tokens
            used += 1
        best = number[at]
        for kind in range(3):
            rest[kind, at] -= demand[kind]
        left[best] -= length
        bins[i] = best
        if rest[0, n_open - 1] <= 0:  # a piece that fills its own bin
            n_open -= 1
    return bins, np.maximum(left[:used], 0)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    added = tuple(t.content for t in model.get_added_tokens_decoder().values())

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in model.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    return encode, added, PieceIds(CACHE_PIECES)


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts and the number of each.

    The tokenizer drops white space and case and never joins letters and signs, so
    texts may be cut there; each distinct piece of text is encoded once.
    """
    encode, added, known = _tokenizer(path)
    counts, codes, distinct = pieces_of(texts, added, lower=True)
    tokens, taken = known.take(codes, distinct, encode)
    ends = np.concatenate([[0], np.cumsum(taken)])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return tokens, np.diff(ends[bounds])


def _pieces(batches, path: str, separator: int, limit: int) -> Iterator[tuple]:
    """``id, piece, start, length, ids`` of every document, cut at ``limit`` tokens."""
    for batch in slices(batches, "text"):
        tokens, sizes = token_ids(batch.column("text"), path)
        at = 0
        for key, size in zip(batch.column("id").to_pylist(), sizes.tolist(), strict=True):
            whole = np.append(tokens[at : at + size], separator).astype("<u4")
            at += size
            for piece, start in enumerate(range(0, len(whole), limit)):
                part = whole[start : start + limit]
                yield key, piece, start, len(part), part.tobytes()


def _placed(lengths: np.ndarray, limits: Limits, slack: int, first: int):
    """Sequence and offset of each piece, -1 for both where a sequence stays open."""
    bins, left = best_fit(lengths, limits)
    order = np.argsort(bins, kind="stable")
    sizes = lengths[order]
    before = np.cumsum(sizes) - sizes
    starts = np.concatenate([[True], bins[order][1:] != bins[order][:-1]]) if len(order) else []
    base = before[np.flatnonzero(starts)] if len(order) else before
    offsets = np.empty(len(lengths), dtype=np.int64)
    offsets[order] = before - base[bins[order]] if len(order) else before
    closed = left[bins] <= slack
    return np.where(closed, first + bins, -1), np.where(closed, offsets, -1), len(left)


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits | None = None,
    separator: int = 0,
) -> DataFrame:
    """``id, piece, start, length, ids, sequence_id, offset``: one row per piece.

    A document is the ids of its whole text and the separator; only longer ones than a
    sequence are cut, into full sequences and a rest. ``ids`` are little-endian unsigned
    32-bit integers. A null or empty text is its separator; null and repeated ids are
    documents of their own; an empty table gives no rows.
    """
    limits = limits or Limits()
    texts = keyed_texts(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, piece int, start bigint, length bigint, ids binary, "
        "sequence_id bigint, offset bigint"
    )
    slack = limits.tokens // 128
    cap = limits.tokens

    def emit(window: list[tuple], slack: int, first: int):
        columns = list(zip(*window, strict=True))
        lengths = np.array(columns[3], dtype=np.int64)
        sequence, offset, used = _placed(lengths, limits, slack, first)
        types = (None, pa.int32(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        none = sequence < 0
        arrays += [pa.array(sequence, mask=none), pa.array(offset, mask=none)]
        names = ["id", "piece", "start", "length", "ids", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(arrays, names), used

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        window: list[tuple] = []
        full: list[tuple] = []  # sequences of their own; they take no place in a window
        for piece in _pieces(batches, path, separator, cap):
            pieces = full if piece[3] == cap else window
            pieces.append(piece)
            if len(pieces) == WINDOW:
                batch, used = emit(pieces, slack, number)
                number += used
                pieces.clear()
                yield batch
        for pieces in filter(None, (full, window)):
            batch, used = emit(pieces, slack, number)
            number += used
            yield batch

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # above every number of the first round
        number = (1 << 62) + (TaskContext.get().partitionId() << 32)
        window: list[tuple] = []
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for row in rows:
                window.append(row)
                if len(window) == 2 * WINDOW:
                    done, used = emit(window, cap, number)
                    number += used
                    window = []
                    yield done
        if window:
            yield emit(window, cap, number)[0]

    # about one window in a partition: within one, rows still lie in the input's order
    parts = max(shuffle_partitions(docs), math.ceil(docs.count() / WINDOW))
    placed = staged(texts.repartition(parts).mapInArrow(first_round, schema), "packed")
    open_pieces = placed.where("sequence_id IS NULL")
    groups = max(1, round(open_pieces.count() / WINDOW))
    again = open_pieces.repartition(groups).mapInArrow(second_round, schema)
    return placed.where("sequence_id IS NOT NULL").unionByName(again)
