"""Sparse rows in blocks of documents, and passes over them that ship few rows of a factor.

A block holds the distinct terms of its documents, so a pass needs one row of the factor
for each of those, not one for each entry. A large block is stored in several rows of
documents, which are worked on one by one. What a pass returns is summed by term: ``back``
rows of the block's terms, and a few rows of moments that have the numbers -1, -2 ..
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged, wide_rows

BLOCK_CELLS = 1 << 17  # entries in a row of a block
GATHERED_ROWS = 8  # rows of blocks, or more, that are packed at a time
# Entries in a block, which is sent the factor's rows once. A worker holds a block whole, and
# the JVM beside it does while it is sent.
UNIT_CELLS = 1 << 20
SHARD_ROWS = 1 << 20  # rows of blocks' terms, each block's own, in a shard of the terms
# A writer holds a group of rows, and a reader decodes one at a time; unless told, a writer
# looks at its size after a hundred rows, which are 230 MB of blocks.
FEW_ROWS = {"parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 4, "parquet.page.size.row.check.min": 1}
BLOCK = "block bigint, terms array<bigint>, ends array<bigint>, at array<bigint>, x array<double>"


def document_blocks(docs: DataFrame, *carried: str) -> DataFrame:
    """Stored blocks of rows ``j, x``: the distinct ``terms`` of a row's documents, and by
    document, up to ``ends``, the places ``at`` in them and the values ``x``. Rows that
    follow one another have the number of one ``block``, up to UNIT_CELLS entries.

    ``carried`` are columns of numbers that go with the documents, also with empty ones.
    """

    names = ["block", "terms", "ends", "at", "x", *carried]
    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.float64())] * (1 + len(carried))]

    def gathered(batches):
        """Batches of some rows of blocks each, whatever came at a time."""
        some, cells = [], 0
        for batch in batches:
            some.append(batch)
            cells += len(batch.column("j").flatten())
            if cells >= GATHERED_ROWS * BLOCK_CELLS:
                yield from pa.Table.from_batches(some).combine_chunks().to_batches()
                some, cells = [], 0
        if some:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()

    def packed(batches):
        number, held = (TaskContext.get().partitionId() << 33) + 1, 0
        for batch in gathered(batches):
            sizes = np.asarray(batch.column("j").value_lengths(), dtype=np.int64)
            j = np.asarray(batch.column("j").flatten())
            x = np.asarray(batch.column("x").flatten())
            ends = np.cumsum(sizes)
            begin = 0
            while begin < len(sizes):
                before = int(ends[begin - 1]) if begin else 0
                end = int(np.searchsorted(ends, before + BLOCK_CELLS, side="right"))
                end = max(end, begin + 1)
                here = slice(before, int(ends[end - 1]))
                terms, at = np.unique(j[here], return_inverse=True)
                if held and held + len(at) > UNIT_CELLS:
                    number, held = number + 1, 0
                held += len(at)
                more = [[np.asarray(batch.column(c))[begin:end]] for c in carried]
                columns = [[number], [terms], [ends[begin:end] - before], [at], [x[here]], *more]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )
                begin = end

    some = docs if carried else docs.where(F.size("j") > 0)
    rows = some.select("j", "x", *[F.col(c).cast("double").alias(c) for c in carried])
    schema = BLOCK + "".join(f", {c} array<double>" for c in carried)
    with wide_rows(docs.sparkSession):
        return staged(rows.mapInArrow(packed, schema), "document-blocks", **FEW_ROWS)


@dataclass
class Block:
    """The documents of a block as sparse rows over its own terms."""

    terms: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    x: np.ndarray
    carried: dict[str, np.ndarray]

    @classmethod
    def read(cls, table, i: int, carried: tuple[str, ...] = ()) -> Block:
        def values(c):
            return np.asarray(table.column(c)[i].values)

        own = [values(c) for c in ("terms", "ends", "at", "x")]
        return cls(*own, {c: values(c) for c in carried})

    def __post_init__(self):
        self.owner = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def times(self, rows: np.ndarray) -> np.ndarray:
        """X R for rows R of the block's terms."""
        out = [
            np.bincount(self.owner, self.x * rows[self.at, a], len(self.ends))
            for a in range(rows.shape[1])
        ]
        return np.stack(out, axis=1)

    def transposed_times(self, w: np.ndarray) -> np.ndarray:
        """X'W of the block's terms."""
        out = [
            np.bincount(self.at, self.x * w[self.owner, a], len(self.terms))
            for a in range(w.shape[1])
        ]
        return np.stack(out, axis=1)


Step = Callable[[np.ndarray, Block], tuple[np.ndarray, np.ndarray]]


def _sums(j: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    """Rows ``j, h``; moments have the numbers -1, -2 .."""
    offsets = pa.array(np.arange(len(h) + 1) * h.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(j, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(h.ravel()))], ["j", "h"]
    )


def _added(partial: DataFrame, k: int) -> DataFrame:
    return partial.groupBy("j").agg(F.array(*[F.sum(F.col("h")[a]) for a in range(k)]).alias("h"))


def rows_table(spark: SparkSession, h: np.ndarray) -> DataFrame:
    """``j, h`` of a matrix by term id."""
    return spark.createDataFrame(pa.Table.from_batches([_sums(np.arange(len(h)), h)]))


def held_pass(
    blocks: DataFrame, h: np.ndarray, step: Step, carried: tuple[str, ...] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``back`` by term and of the moments, for a factor small enough to broadcast.

    One job; every task adds up its blocks before anything is shuffled.
    """
    n, k = h.shape
    shared = blocks.sparkSession.sparkContext.broadcast(h)

    def added(batches):
        back, moments = np.zeros((n, k)), None
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.read(batch, i, carried)
                mine, more = step(shared.value[block.terms], block)
                back[block.terms] += mine
                moments = more if moments is None else moments + more
        if moments is not None:
            held = np.flatnonzero(back.any(axis=1))
            yield _sums(held, back[held])
            yield _sums(-1 - np.arange(len(moments)), moments)

    sums = _added(blocks.mapInArrow(added, "j bigint, h array<double>"), k).toArrow()
    shared.destroy()  # the driver's copy too, else they add up until it collects its garbage
    at = np.asarray(sums.column("j"))
    rows = np.asarray(sums.column("h").combine_chunks().flatten()).reshape(-1, k)
    back = np.zeros((n, k))
    back[at[at >= 0]] = rows[at >= 0]
    return back, _moments(at, rows, k)


def _moments(at: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    found = np.zeros((int((at < 0).sum()), k))
    found[-1 - at[at < 0]] = rows[at < 0]
    return found


def _flat(table: pa.Table, column: str) -> np.ndarray:
    """The values of a column of lists, one after the other."""
    return np.asarray(table.column(column).combine_chunks().flatten())


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _own_terms(table: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a whole block by shard and number, and the shards with how many each."""
    terms = np.unique(_flat(table, "terms"))
    terms = terms[np.lexsort((terms, terms % shards))]
    return terms, *np.unique(terms % shards, return_counts=True)


class PlacedBlocks:
    """Blocks that keep their place for all passes; a lost one is read again.

    Terms are dealt into shards by their number. ``named`` says which terms of a shard each
    block has; it keeps its place too, so a pass shuffles the factor, one packed list of its
    rows for each block and shard, and the packed sums that come back.
    """

    def __init__(self, blocks: DataFrame, carried: tuple[str, ...] = (), **bounds):
        parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = blocks.agg(F.sum(F.size("terms"))).first()[0] or 0
        shards = self.shards = max(parts, math.ceil(rows / SHARD_ROWS))
        self.carried = carried
        self.blocks = _placed(blocks, parts, "block")

        def split(table):
            terms, shard, sizes = _own_terms(table, shards)
            block = np.full(len(shard), table.column("block")[0].as_py())
            return pa.table([block, shard.astype(np.int64), _lists(terms, sizes)], ["block", "shard", "j"])

        own = self.blocks.select("block", "terms").groupBy("block")
        named = own.applyInArrow(split, "block bigint, shard bigint, j array<bigint>")
        self.named = _placed(named, parts, "shard")

    def close(self) -> None:
        self.blocks.unpersist()
        self.named.unpersist()

    def _sent(self, h: DataFrame, k: int) -> DataFrame:
        """``block, shard, h``: the rows of each block's terms, zero where ``h`` lacks one."""
        shards = self.shards

        def looked_up(rows, named):
            j = np.asarray(rows.column("j"))
            order = np.argsort(j)
            known = np.concatenate([_flat(rows, "h").reshape(-1, k)[order], np.zeros((1, k))])
            wanted = _flat(named, "j")
            at = np.searchsorted(j[order], wanted)
            found = at < len(j)
            found[found] = j[order][at[found]] == wanted[found]
            values = known[np.where(found, at, len(j))].ravel()
            sizes = np.asarray(named.column("j").combine_chunks().value_lengths())
            columns = [named.column("block"), named.column("shard"), _lists(values, sizes * k)]
            return pa.table(columns, ["block", "shard", "h"])

        by_shard = h.select(F.pmod("j", F.lit(shards)).alias("shard"), "j", "h").groupBy("shard")
        return by_shard.cogroup(self.named.groupBy("shard")).applyInArrow(
            looked_up, "block bigint, shard bigint, h array<double>"
        )

    def _each(self, h: DataFrame, k: int, work: Callable, schema: str) -> DataFrame:
        """``work`` on every block: its terms and their shards, the rows sent to it, and its
        documents row by row with the places of their terms."""
        shards, carried = self.shards, self.carried

        def run(sent, table):
            terms, *of_shards = _own_terms(table, shards)
            by_shard = sent.take(np.argsort(np.asarray(sent.column("shard"))))
            held = _flat(by_shard, "h").reshape(-1, k)
            order = np.argsort(terms)

            def documents():
                for i in range(table.num_rows):
                    block = Block.read(table, i, carried)
                    yield order[np.searchsorted(terms[order], block.terms)], block

            return work(terms, *of_shards, held, documents())

        sent = self._sent(h, k).groupBy("block")
        return sent.cogroup(self.blocks.groupBy("block")).applyInArrow(run, schema)

    def run(self, h: DataFrame, k: int, step: Step) -> tuple[DataFrame, np.ndarray]:
        """The same sums for a factor table ``j, h``: each block is sent the rows of its
        terms; terms that the table lacks count as zero. The sums are a stored table, to be
        discarded once they are used."""

        def added(terms, shard, sizes, held, documents):
            back, moments = np.zeros((len(terms), k)), None
            for at, block in documents:
                mine, more = step(held[at], block)
                back[at] += mine
                moments = more if moments is None else moments + more
            number = -1 - np.arange(len(moments))
            shard = np.concatenate([shard, [-1]]).astype(np.int64)
            sizes = np.concatenate([sizes, [len(moments)]])
            j, values = np.concatenate([terms, number]), np.vstack([back, moments]).ravel()
            return pa.table([shard, _lists(j, sizes), _lists(values, sizes * k)], ["shard", "j", "h"])

        def summed(table):
            j, at = np.unique(_flat(table, "j"), return_inverse=True)
            rows = _flat(table, "h").reshape(-1, k)
            sums = [np.bincount(at, rows[:, a], len(j)) for a in range(k)]
            return pa.Table.from_batches([_sums(j, np.stack(sums, axis=1))])

        partial = self._each(h, k, added, "shard bigint, j array<bigint>, h array<double>")
        sums = staged(
            partial.groupBy("shard").applyInArrow(summed, "j bigint, h array<double>"), "block-sums"
        )
        factor = sums.where("j >= 0")
        factor.staged_at = getattr(sums, "staged_at", None)
        found = sums.where("j < 0").toArrow()
        at = np.asarray(found.column("j"))
        values = np.asarray(found.column("h").combine_chunks().flatten()).reshape(-1, k)
        return factor, _moments(at, values, k)

    def answers(
        self, h: DataFrame, k: int, answer: Callable[[np.ndarray, Block], np.ndarray], row: str
    ) -> DataFrame:
        """``row, v``: numbers ``answer`` gives for every document, by a carried number."""

        def answered(terms, shard, sizes, held, documents):
            rows, found = [], []
            for at, block in documents:
                rows.append(block.carried[row].astype(np.int64))
                found.append(answer(held[at], block))
            v = np.concatenate(found)
            sizes = np.full(len(v), v.shape[1])
            return pa.table([np.concatenate(rows), _lists(v.ravel(), sizes)], [row, "v"])

        return self._each(h, k, answered, f"{row} bigint, v array<double>")


def _placed(table: DataFrame, parts: int, key: str) -> DataFrame:
    """Rows that stay where their key puts them, in its order. They are placed at once, as
    the planner knows the place of stored rows only."""
    placed = table.repartition(parts, key).sortWithinPartitions(key).persist(StorageLevel.DISK_ONLY)
    placed.count()
    return placed
