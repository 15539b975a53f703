"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are brought to unit length, where the nearest by cosine are the nearest by
distance. A shard's tree halves its vectors again and again by their distance to a
vantage point and keeps for each half the range of those distances. A query skips a
half when the triangle inequality puts all of it, times a relaxation factor, beyond
the k-th best found so far: with factor one nothing is lost, above one less is visited.

Trees stay in their shard; blocks of queries pass by them one at a time, and only the
k best of each query and shard are merged.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 64
FACTOR = 1.0  # exact; what a larger one loses depends on the vectors
SAME = 1e-6  # distances closer than this are not told apart when pruning
KEY_DIGITS = 12  # cosines equal to so many digits are ties


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """Tree over unit vectors: nodes in arrays, points reordered so leaves are ranges.

    ``order`` is the new order. A node has its vantage point, two children (-1 for a
    leaf), the range of its points and, for both children, the least and greatest
    distance to the vantage point. Equal distances are split by position, so copies of
    one vector do not unbalance the tree.
    """
    order = np.arange(len(points))
    vantage, child, span, bounds = [], [], [], []

    def node(begin: int, end: int) -> int:
        at = len(vantage)
        vantage.append(0)
        child.append((-1, -1))
        span.append((begin, end))
        bounds.append((0.0, 0.0, 0.0, 0.0))
        return at

    todo = [node(0, len(points))]
    while todo:
        at = todo.pop()
        begin, end = span[at]
        if end - begin <= LEAF_ROWS:
            continue
        inside = order[begin:end]
        # the point farthest from the first one lies at the rim, which spreads distances
        far = inside[np.argmin(points[inside] @ points[inside[0]])]
        distance = np.sqrt(np.maximum(0, 2 - 2 * (points[inside] @ points[far])))
        by = np.argsort(distance, kind="stable")
        order[begin:end], distance = inside[by], distance[by]
        half = (end - begin) // 2
        vantage[at] = far
        bounds[at] = (distance[0], distance[half - 1], distance[half], distance[-1])
        child[at] = (node(begin, begin + half), node(begin + half, end))
        todo += child[at]
    return {
        "order": order,
        "vantage": np.array(vantage, dtype=np.int64),
        "child": np.array(child, dtype=np.int64).reshape(-1, 2),
        "span": np.array(span, dtype=np.int64).reshape(-1, 2),
        "bounds": np.array(bounds, dtype=np.float64).reshape(-1, 4),
    }


class Search:
    """The k best points of a tree for a block of unit queries."""

    def __init__(self, tree, points, ids, queries, own, k: int, factor: float):
        self.tree, self.points, self.ids = tree, points[tree["order"]], ids[tree["order"]]
        self.vantage = points[tree["vantage"]]
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.key = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.place = np.full((len(queries), k), -1)
        self.reach = np.full(len(queries), np.inf)
        self.visited = 0
        self.visit(0, np.arange(len(queries)))

    def visit(self, node: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        inner, outer = self.tree["child"][node]
        if inner < 0:
            self.compare(*self.tree["span"][node], rows)
            return
        near, near_end, far, far_end = self.tree["bounds"][node]
        distance = np.sqrt(np.maximum(0, 2 - 2 * (self.queries[rows] @ self.vantage[node])))
        to_inner = np.maximum(0, np.maximum(distance - near_end, near - distance))
        to_outer = np.maximum(0, np.maximum(distance - far_end, far - distance))
        first = to_inner <= to_outer
        self.visit(inner, rows[first])
        self.visit(outer, rows[~first])
        # the k-th best found on the near side decides about the far side
        again = first & (to_outer * self.factor <= self.reach[rows])
        self.visit(outer, rows[again])
        again = ~first & (to_inner * self.factor <= self.reach[rows])
        self.visit(inner, rows[again])

    def compare(self, begin: int, end: int, rows: np.ndarray) -> None:
        self.visited += len(rows) * (end - begin)
        key = np.round(self.queries[rows] @ self.points[begin:end].T, KEY_DIGITS)
        key[self.own[rows][:, None] == self.ids[None, begin:end]] = -np.inf
        better = (key >= self.key[rows, -1:]) & (key > -np.inf)
        some = better.any(axis=1)
        rows, key = rows[some], key[some]
        if not len(rows):
            return
        wide = (len(rows), end - begin)
        key = np.concatenate([self.key[rows], key], axis=1)
        ids = np.concatenate(
            [self.found[rows], np.broadcast_to(self.ids[begin:end], wide)], axis=1
        )
        place = np.concatenate(
            [self.place[rows], np.broadcast_to(np.arange(begin, end), wide)], axis=1
        )
        best = np.lexsort((ids, -key))[:, : self.k]
        self.key[rows] = np.take_along_axis(key, best, axis=1)
        self.found[rows] = np.take_along_axis(ids, best, axis=1)
        self.place[rows] = np.take_along_axis(place, best, axis=1)
        last = self.key[rows, -1]
        self.reach[rows] = np.where(
            last > -np.inf, np.sqrt(np.maximum(0, 2 - 2 * np.maximum(last, -1))) + SAME, np.inf
        )


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of two matrices, in double precision."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def _matrices(batch_rows: list[tuple]) -> dict[int, tuple]:
    """``dimension: (rows, ids, vectors)``; only vectors of one dimension are compared."""
    by_size: dict[int, list] = {}
    for row, key, vector in batch_rows:
        by_size.setdefault(len(vector), []).append((row, key, vector))
    return {
        size: (
            np.array([r[0] for r in rows], dtype=np.int64),
            np.array([r[1] for r in rows], dtype=np.int64),
            np.array([r[2] for r in rows], dtype=np.float64),
        )
        for size, rows in by_size.items()
    }


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of very large or small components stay finite
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _dump(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return dict(arrays)


def _packed(with_tree: bool):
    """One row per partition and dimension: its vectors, with their tree if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ]
        part = TaskContext.get().partitionId()
        for size, (row, ids, vectors) in _matrices(rows).items():
            arrays = {"row": row, "ids": ids, "vectors": vectors}
            if with_tree:
                arrays |= {f"tree_{k}": v for k, v in build(_unit(vectors)).items()}
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "size": pa.array([size], pa.int32()),
                    "data": pa.array([_dump(arrays)], pa.binary()),
                }
            )

    return run


PACKED = "part int, size int, data binary"
FOUND = "query_row bigint, query_id bigint, vec_id bigint, score double"


def vectors_of(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, vector`` of the usable vectors."""
    return df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stored trees over all ``row, id, vector``; rows are dealt evenly, whatever they hold."""
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    return staged(vectors.repartition(shards).mapInArrow(_packed(True), PACKED), "vp-trees")


def search(
    trees: DataFrame,
    queries: DataFrame,
    k: int = 5,
    factor: float = FACTOR,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_row, query_id, vec_id, score, rank``: the k best found for each query.

    ``queries`` are ``row, id, vector``. Candidates that bear the query's id are left
    out. Scores are cosines of the vectors as given; ties go to the smaller id.
    """
    blocks = max(1, math.ceil(queries.count() / block_rows))
    packed = staged(queries.repartition(blocks).mapInArrow(_packed(False), PACKED), "query-blocks")
    # the shard comes first, then the blocks that pass by it
    visits = trees.select(
        F.struct(F.col("part").alias("shard"), "size").alias("shard"),
        F.lit(-1).alias("block"),
        "data",
    ).unionByName(
        packed.join(F.broadcast(_shards(trees)), "size").select(
            F.struct("shard", "size").alias("shard"), F.col("part").alias("block"), "data"
        )
    )
    placed = visits.repartition("shard").sortWithinPartitions("shard", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for block, data in zip(
                batch.column("block").to_pylist(), batch.column("data"), strict=True
            ):
                arrays = _load(data.as_py())
                if block < 0:
                    shard = arrays | {"unit": _unit(arrays["vectors"])}
                else:
                    yield _answers(shard, arrays, k, factor)

    found = placed.mapInArrow(run, FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _shards(trees: DataFrame) -> DataFrame:
    """``shard, size``: two integers per SHARD_ROWS vectors."""
    return trees.select(F.col("part").alias("shard"), "size")


def _answers(shard, block, k: int, factor: float) -> pa.RecordBatch:
    tree = {n.removeprefix("tree_"): a for n, a in shard.items() if n.startswith("tree_")}
    result = Search(
        tree, shard["unit"], shard["ids"], _unit(block["vectors"]), block["ids"], k, factor
    )
    # with fewer candidates than k a place may hold none, or the query itself
    query, column = np.nonzero(result.key > -np.inf)
    place = tree["order"][result.place[query, column]]
    score = cosine(block["vectors"][query], shard["vectors"][place])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block["row"][query]),
            pa.array(block["ids"][query]),
            pa.array(shard["ids"][place]),
            pa.array(score),
        ],
        ["query_row", "query_id", "vec_id", "score"],
    )


def nearest(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``.

    Null, zero or non-finite vectors and rows without an id take no part. Vectors of
    another dimension are no candidates. Rows that repeat a query's id are answered each,
    and are no candidates of it. With fewer candidates than ``k`` all are returned; an
    empty table gives no rows.
    """
    vectors = vectors_of(df, id_col, vector_col)
    trees = index(vectors, shard_rows)
    queries = vectors.where(F.col("id") % every == 0)
    found = search(trees, queries, k, factor)
    return found.select("query_id", "rank", "vec_id", "score")
