"""Near duplicates of vectors by an inverted multi-index.

Unit vectors are cut into halves, and each half has a codebook of its own. A vector lies
in the cell of the product grid that its two nearest code words name. A multi-sequence
traversal visits the cells in rising order of the sum of the distances of both halves;
how many it visits is measured beforehand, so that of partners at the very threshold the
wanted share (``recall``) lies in a visited cell. Pairs that meet in a cell are verified
on the vectors as given.

A vector visits only cells numbered above its own, so no pair meets twice; the share is
measured for this one direction.

Groups of near copies that hold much of the table would fill one cell and cost a
comparison for every pair. They are seen in the sample that the codebooks are fitted on:
vectors within half the threshold's angle of such a group's centre are linked with each
other by the triangle inequality, so they are counted, not compared. What is left of a
large cell is compared in blocks that return sums and the links of a spanning forest,
never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, skew_join
from ..session import staged
from .common import shuffle_partitions
from .components import components
from .vptree import cosine, usable

SIMILARITY = 0.93
RECALL = 0.98
SAMPLE_VALUES = 1_200_000  # numbers in the sample the codebooks are fitted on
CELL_ROWS = 256  # vectors in a cell, if all cells were alike
LEAST_CODES, MOST_CODES = 2, 512
ROUNDS = 10
PROBES = 4000  # partners at the threshold for which visits are measured
DENSE_SHARE = 200  # a group of near copies is dense with more than 1/200 of the sample
BLOCK_VALUES = 1 << 18  # numbers in a block of a large cell
STEP_CELLS = 1 << 22  # products worked on at a time
SAME = 1e-9  # products closer to the threshold are taken again, by the plain formula
SEED = 11


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows brought to length one; scaled first, so that squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of points to code words."""
    return np.maximum(
        0, (points * points).sum(axis=1)[:, None] - 2 * points @ codes.T + (codes * codes).sum(axis=1)
    )


def codebook(points: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Code words by Lloyd's rounds from points drawn without replacement."""
    codes = points[rng.permutation(len(points))[:size]].copy()
    for _ in range(ROUNDS):
        nearest = _distances(points, codes).argmin(axis=1)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, points)
        number = np.bincount(nearest, minlength=len(codes))
        filled = number > 0
        codes[filled] = sums[filled] / number[filled, None]
    return codes


def traverse(first: np.ndarray, second: np.ndarray, visits: int) -> np.ndarray:
    """The ``visits`` nearest cells of each row, nearest first.

    ``first`` and ``second`` are distances to the code words of both halves. A cell at
    places i and j of the two sorted sequences has (i + 1)(j + 1) - 1 cells before it, so
    the traversal never leaves the front of places whose product is within ``visits``.
    """
    size = second.shape[1]
    a, b = (np.argsort(d, axis=1, kind="stable") for d in (first, second))
    front = [
        (i, j)
        for i in range(min(visits, a.shape[1]))
        for j in range(min(visits // (i + 1), size))
    ]
    i, j = np.array(front).T
    total = np.take_along_axis(first, a, axis=1)[:, i] + np.take_along_axis(second, b, axis=1)[:, j]
    best = np.argsort(total, axis=1, kind="stable")[:, :visits]
    return np.take_along_axis(a[:, i] * size + b[:, j], best, axis=1)


@dataclass
class Index:
    """Two codebooks, the number of cells to visit, and the centres of dense groups."""

    width: int  # shorter vectors are filled up with zeros, which keeps their cosines
    half: int
    first: np.ndarray
    second: np.ndarray
    visits: int
    least: float
    labels: list[str]
    centres: np.ndarray

    def cells(self, units: np.ndarray) -> np.ndarray:
        """Cells in the order of the traversal; the first one is the vector's own."""
        half = self.half
        return traverse(
            _distances(units[:, :half], self.first),
            _distances(units[:, half:], self.second),
            self.visits,
        )

    def balls(self, units: np.ndarray, labels: list[str]) -> np.ndarray:
        """The first dense group of the same label that holds the vector, else -1."""
        ball = np.full(len(units), -1)
        if not len(self.centres):
            return ball
        tight = math.cos(math.acos(self.least) / 2) + SAME
        own = np.array(labels, dtype=object)
        for k in range(len(self.centres)):
            here = np.flatnonzero((ball < 0) & (own == self.labels[k]))
            ball[here[units[here] @ self.centres[k] >= tight]] = k
        return ball


def visits_needed(
    units: np.ndarray, index: Index, recall: float, rng: np.random.Generator
) -> int:
    """Cells to visit so that partners at the threshold are met with the wanted share.

    A partner is made of a sampled vector by turning it by the threshold's angle towards
    another sampled one, so that it differs as the vectors of the table differ.
    """
    if len(units) < 2:
        return 1
    at = rng.integers(0, len(units), PROBES)
    to = (at + rng.integers(1, len(units), PROBES)) % len(units)
    x, z = units[at], units[to]
    z = z - (x * z).sum(axis=1, keepdims=True) * x
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    fits = length[:, 0] > 1e-6
    x, z = x[fits], z[fits] / length[fits]
    if not len(x):
        return 1
    y = index.least * x + math.sqrt(1 - index.least**2) * z
    size, half = len(index.second), index.half
    ranks = []
    for part in np.array_split(np.arange(len(x)), max(1, len(x) * size * len(index.first) >> 22)):
        grid = [
            _distances(v[part, :half], index.first)[:, :, None]
            + _distances(v[part, half:], index.second)[:, None, :]
            for v in (x, y)
        ]
        flat = [g.reshape(len(part), -1) for g in grid]
        own = [f.argmin(axis=1) for f in flat]
        # the vector of the smaller cell visits the other one
        for here, there in ((0, 1), (1, 0)):
            rows = np.flatnonzero(own[here] < own[there])
            target = flat[here][rows, own[there][rows]]
            ranks.append((flat[here][rows] < target[:, None]).sum(axis=1) + 1)
        ranks.append(np.ones((own[0] == own[1]).sum(), dtype=np.int64))
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)])


def dense_groups(units: np.ndarray, labels: list[str], least: float):
    """Labels and centres of the groups that hold more than 1/DENSE_SHARE of the sample.

    The vector with the most others within half the angle starts a group; its centre is
    moved to the mean of what it holds. As shares add up, there are at most DENSE_SHARE.
    """
    tight = math.cos(math.acos(least) / 2)
    needed = len(units) / DENSE_SHARE
    names = np.array(labels, dtype=object)
    found: list[tuple[str, np.ndarray]] = []
    for label in sorted(set(labels)):
        points = units[names == label]
        while len(points) > max(needed, 2):
            trial = points[np.random.default_rng(SEED).permutation(len(points))[:2048]]
            held = np.zeros(len(trial), dtype=np.int64)
            for part in np.array_split(np.arange(len(points)), 1 + len(points) * len(trial) // STEP_CELLS):
                held += (trial @ points[part].T >= tight).sum(axis=1)
            centre = trial[held.argmax()]
            for _ in range(ROUNDS):
                near = points @ centre >= tight
                moved = points[near].mean(axis=0)
                moved /= np.sqrt(moved @ moved)
                if (points @ moved >= tight).sum() < near.sum():
                    break
                centre = moved
            near = points @ centre >= tight
            if near.sum() <= max(needed, 2):
                break
            found.append((label, centre))
            points = points[~near]
    width = units.shape[1]
    return [f[0] for f in found], np.array([f[1] for f in found]).reshape(-1, width)


def build(
    sample: list[tuple[str, list[float]]], rows: int, width: int, least: float, recall: float
) -> Index:
    """Index fitted on sampled ``label, vector``; ``rows`` is the size of the whole table."""
    rng = np.random.default_rng(SEED)
    units = unit(_padded([v for _, v in sample], width))
    half = width // 2
    size = min(max(round(math.sqrt(rows / CELL_ROWS)), LEAST_CODES), MOST_CODES, len(units))
    labels, centres = dense_groups(units, [label for label, _ in sample], least)
    books = [codebook(part, size, rng) for part in (units[:, :half], units[:, half:])]
    index = Index(width, half, *books, 1, least, labels, centres)
    index.visits = visits_needed(units, index, recall, rng)
    return index


def _padded(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


# --- the jobs


def _numbers(df: DataFrame, vector_col: str) -> Column:
    """The vector as it is stored, if it is of floats or doubles, else as doubles."""
    kind = df.schema[vector_col].dataType.simpleString()
    vector = F.col(f"`{vector_col}`")
    return vector if kind in ("array<float>", "array<double>") else vector.cast("array<double>")


def _placed(index: Index):
    """One row for the own cell of each vector and one for each cell it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                labels = part.column("label").to_pylist()
                vectors = part.column("vector").to_pylist()
                units = unit(_padded(vectors, index.width))
                cells = index.cells(units)
                own = cells[:, :1]
                sizes = np.array([len(v) for v in vectors], dtype=np.int32)
                # a dense group was seen at full width alone
                ball = np.where(sizes == index.width, index.balls(units, labels), -1)
                wanted = (cells > own) | (np.arange(cells.shape[1]) == 0)
                row, at = np.nonzero(wanted)
                take = pa.array(row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": part.column("node").take(take),
                        "label": part.column("label").take(take),
                        "size": pa.array(sizes[row]),
                        "cell": pa.array(cells[row, at]),
                        "home": pa.array(at == 0),
                        "ball": pa.array(ball[row].astype(np.int32)),
                    }
                )

    return run


PLACED = "node bigint, label string, size int, cell bigint, home boolean, ball int"


def _spanning(parent: np.ndarray, linked: np.ndarray) -> None:
    """Unite all classes that one row of links names; a class bears its smallest place."""
    classes = np.unique(parent[linked])
    if len(classes) > 1:
        parent[np.isin(parent, classes)] = classes[0]


def _unit_links(least: float):
    """Sums and spanning links of one unit of work: a cell, or two blocks of a large one."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node = np.asarray(table.column("node"))
        by = np.argsort(node, kind="stable")
        table, node = table.take(pa.array(by)), node[by]
        home = np.asarray(table.column("home").to_numpy(zero_copy_only=False), dtype=bool)
        ball, weight = np.asarray(table.column("ball")), np.asarray(table.column("weight"))
        block = np.unique(np.asarray(table.column("block")), return_inverse=True)[1]
        label = np.asarray(table.column("label").dictionary_encode().combine_chunks().indices)
        vectors = np.array(table.column("vector").to_pylist(), dtype=np.float64)
        units = unit(vectors)
        # blocks of one unit meet each other; alone, the rows of the one meet themselves
        across = block.max(initial=0) > 0
        n = len(node)
        links = np.zeros(n, dtype=np.int64)
        parent = np.arange(n)
        step = max(1, STEP_CELLS // max(1, n))
        for begin in range(0, n, step):
            rows = np.arange(begin, min(n, begin + step))
            score = units[rows] @ units.T
            hit = score >= least - SAME
            r, c = np.nonzero(hit)
            r = rows[r]
            keep = (
                (home[r] | home[c])
                & ((ball[r] < 0) | (ball[r] != ball[c]))
                & (label[r] == label[c])
                & (r < c)
            )
            if across:
                keep &= block[r] != block[c]
            r, c = r[keep], c[keep]
            near = score[r - begin, c] < least + SAME
            if near.any():
                close = np.flatnonzero(near)
                below = cosine(vectors[r[close]], vectors[c[close]]) < least
                keep = np.ones(len(r), dtype=bool)
                keep[close[below]] = False
                r, c = r[keep], c[keep]
            np.add.at(links, r, weight[c])
            np.add.at(links, c, weight[r])
            cuts = np.flatnonzero(np.diff(r, prepend=-1, append=-1)).tolist()
            for s, e in pairwise(cuts):
                _spanning(parent, np.append(c[s:e], r[s]))
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some], "root": node[parent[some]]})

    return run


def _units(placed: DataFrame, block_rows: int) -> DataFrame:
    """``key, unit, block`` and the row: every block meets every other of its cell that
    holds a partner for it. Most cells are one block and one unit.
    """
    kind = F.struct("home", "ball")
    keyed = placed.withColumn("key", F.xxhash64("label", "size", "cell"))
    kinds = staged(
        keyed.groupBy("key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")), "cell-kinds"
    )
    total = F.aggregate("kinds", F.lit(0).cast("bigint"), lambda s, k: s + k["n"])
    homes = F.aggregate(
        F.filter("kinds", lambda k: k["kind"]["home"]), F.lit(0).cast("bigint"), lambda s, k: s + k["n"]
    )
    cells = staged(
        kinds.groupBy("key")
        .agg(F.collect_list(F.struct("kind", "n")).alias("kinds"))
        .select("key", "kinds", total.alias("n"), homes.alias("homes"))
        .where("n > 1 and homes > 0"),
        "cells",
    )
    sized = skew_join(keyed, cells, "key", hot_keys(cells, "key"), "inner")

    def blocks(n: Column) -> Column:
        return F.ceil(n / block_rows).cast("int")

    mine = F.filter("kinds", lambda k: k["kind"] == kind)[0]["n"]
    block = F.struct("home", "ball", F.pmod(F.hash("node"), blocks(mine)).alias("part"))
    every = F.flatten(
        F.transform(
            "kinds",
            lambda k: F.transform(
                F.sequence(F.lit(0), blocks(k["n"]) - 1),
                lambda p: F.struct(
                    k["kind"]["home"].alias("home"), k["kind"]["ball"].alias("ball"), p.alias("part")
                ),
            ),
        )
    )

    def partner(b: Column) -> Column:
        same_ball = (b["ball"] >= 0) & (b["ball"] == F.col("ball"))
        return (b["home"] | F.col("home")) & ~same_ball

    units = F.transform(
        F.filter(every, partner),
        lambda b: F.struct(F.least(b, F.col("block")).alias("a"), F.greatest(b, F.col("block")).alias("b")),
    )
    whole = F.struct(F.col("block").alias("a"), F.col("block").alias("b"))
    nothing = F.struct(
        F.lit(None).cast("boolean").alias("home"), F.lit(None).cast("int").alias("ball"), F.lit(0).alias("part")
    )
    small = F.col("n") <= block_rows
    return (
        sized.withColumn("block", F.when(small, nothing).otherwise(block))
        .withColumn("unit", F.explode(F.when(small, F.array(whole)).otherwise(units)))
        .select("key", "unit", F.xxhash64("block").alias("block"), "node", "label", "home", "ball")
    )


def _sample(nodes: DataFrame, rows: int, width: int) -> list[tuple[str, list[float]]]:
    """About SAMPLE_VALUES numbers of vectors, chosen by their digest alone."""
    wanted = max(1, SAMPLE_VALUES // width)
    place = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    chosen = nodes
    if rows > wanted:
        chosen = nodes.where(place < F.lit(int(wanted / rows * (1 << 32))))
    table = chosen.select("label", "vector").toArrow()
    return list(zip(table.column("label").to_pylist(), table.column("vector").to_pylist(), strict=True))


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """``id, n_links, component_id, kept``: one row per input row.

    Vectors of one label and one dimension whose cosine is ``least`` (above 0) or more are
    linked; ``n_links`` counts the other rows a row is linked with, copies included, and
    ``component_id`` is the smallest id that links reach. Pairs are found with about the
    wanted ``recall`` or better, and none below ``least`` is linked. Rows whose label is
    null, or whose vector is null, empty, zero or holds null or non-finite numbers, have
    no links. A null id is never a component's id unless all are null, and then the row is
    kept; rows may repeat an id; other columns play no part; an empty table gives no rows.
    """
    rows = staged(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{label_col}`").cast("string").alias("label"),
            _numbers(df, vector_col).alias("vector"),
        ).withColumn(
            "digest",
            F.when(
                F.col("label").isNotNull() & usable(F.col("vector")),
                F.unhex(F.sha2(F.to_json(F.struct("label", F.col("vector").cast("string"))), 256)),
            ),
        ),
        "vectors",
    )
    copies = staged(
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("row").alias("node"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n")),
        "distinct-vectors",
    )
    nodes = staged(
        rows.drop("id").join(
            copies.select(F.col("node").alias("row"), F.col("n").alias("weight")), "row"
        ).withColumnRenamed("row", "node"),
        "vector-nodes",
    )
    total, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    label = copies.select("node", F.col("node").alias("label")).limit(0)
    links = copies.select("node", F.lit(0).cast("bigint").alias("links")).limit(0)
    if total > 1:
        links, label = _linked(nodes, total, width, least, recall)
    return _answer(rows, copies, links, label)


def _linked(nodes: DataFrame, total: int, width: int, least: float, recall: float):
    """``node, links`` and ``node, label`` of the nodes that links reach."""
    index = build(_sample(nodes, total, width), total, width, least, recall)
    parts = max(shuffle_partitions(nodes), math.ceil(total * width / (BLOCK_VALUES * 16)))
    spread = nodes.select("node", "label", "vector").repartition(parts)
    placed = staged(spread.mapInArrow(_placed(index), PLACED), "cells-visited")
    units = _units(placed, max(2, BLOCK_VALUES // width))
    work = units.join(nodes.select("node", "weight", "vector"), "node")
    found = staged(
        work.groupBy("key", "unit").applyInArrow(
            _unit_links(least), "node bigint, links bigint, root bigint"
        ),
        "unit-links",
    )
    in_ball = placed.where("home and ball >= 0").select("node", "ball", "label")
    held = staged(in_ball.join(nodes.select("node", "weight"), "node"), "dense-nodes")
    # at most DENSE_SHARE balls
    balls = held.groupBy("ball").agg(F.sum("weight").alias("all"), F.min("node").alias("root"))
    counted = held.join(F.broadcast(balls), "ball").select(
        "node", (F.col("all") - F.col("weight")).alias("links"), "root"
    )
    both = found.unionByName(counted)
    links = both.groupBy("node").agg(F.sum("links").alias("links"))
    return links, components(
        both.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    )


def _answer(rows: DataFrame, copies: DataFrame, links: DataFrame, label: DataFrame) -> DataFrame:
    named = staged(
        copies.join(label, "node", "left").join(links, "node", "left").select(
            "digest",
            "n",
            "least_id",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("label", "node").alias("label"),
        ),
        "labelled-vectors",
    )
    classes = staged(
        named.groupBy("label").agg(
            F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("nodes")
        ),
        "vector-classes",
    )
    of_vector = staged(
        skew_join(
            named.select("digest", "n", "n_links", "label"),
            classes.select("label", "component_id"),
            "label",
            hot_keys(classes, "label", "nodes"),
            "inner",
        ),
        "vector-answers",
    )
    joined = skew_join(
        rows.select("id", "digest"),
        of_vector.select("digest", "n_links", "component_id"),
        "digest",
        hot_keys(of_vector, "digest"),
        "left",
    )
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        "id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
