"""Multinomial regression whose coefficients are a table, for any number of terms.

Documents are sparse rows in blocks (:mod:`blocks`); a pass sends each block the
coefficients of its terms and sums the gradient by term. The fit is L-BFGS in its
vector-free form: the coefficients, the gradient and the last steps stand beside each other
in one table ``(j, v)``, all their dot products come from one aggregate, and the direction
is a combination of those vectors whose few factors the driver works out. Where a measured
factor is small it is a matrix on the driver instead; both ways take the same steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, BROADCAST_ROWS
from ..functions.arrays import argmax
from ..session import discard, staged
from .blocks import Block, PlacedBlocks, document_blocks, held_pass, rows_table
from .joins import lookup_join

MEMORY = 6  # steps remembered
ARMIJO = 1e-4  # share of the foreseen gain a step must bring
HALVINGS = 25
LEAST_CURVE = 1e-12


@dataclass
class WideModel:
    """``coefficients``: ``j, h`` with one number for each class; loss of every step."""

    coefficients: DataFrame
    intercepts: np.ndarray
    losses: list[float]
    converged: bool


def training_rows(weights: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Stored ``j, x, y`` of each labelled document of long ``key, term_id, weight``.

    ``labels`` has one row ``key, label`` for a document, also for one without terms;
    a null label takes no part.
    """
    rows = weights.groupBy(key).agg(
        F.collect_list(F.struct(F.col("term_id").alias("j"), F.col("weight").alias("x"))).alias("items")
    )
    known = labels.where(F.col("label").isNotNull()).select(key, F.col("label").cast("double").alias("y"))
    joined = known.join(rows, key, "left").select(
        F.coalesce("items.j", F.array().cast("array<bigint>")).alias("j"),
        F.coalesce("items.x", F.array().cast("array<double>")).alias("x"),
        "y",
    )
    return staged(joined, "training-rows")


def _loss_step(intercepts: np.ndarray):
    """Summed loss and gradient of one block at given intercepts."""

    def run(rows: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
        score = block.times(rows) + intercepts
        score -= score.max(axis=1, keepdims=True)
        share = np.exp(score)
        total = share.sum(axis=1, keepdims=True)
        y = block.carried["y"].astype(np.int64)
        at = np.arange(len(y))
        loss = float((np.log(total[:, 0]) - score[at, y]).sum())
        error = share / total
        error[at, y] -= 1
        first = np.zeros(rows.shape[1])
        first[0] = loss
        return block.transposed_times(error), np.vstack([error.sum(axis=0), first])

    return run


def _apart_step(intercepts: np.ndarray):
    """The same for one binary loss by class, each against all others."""

    def run(rows: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
        score = block.times(rows) + intercepts
        y = block.carried["y"].astype(np.int64)[:, None] == np.arange(rows.shape[1])
        first = np.zeros(rows.shape[1])
        first[0] = float(np.logaddexp(0.0, np.where(y, -score, score)).sum())
        error = np.exp(-np.logaddexp(0.0, -score)) - y
        return block.transposed_times(error), np.vstack([error.sum(axis=0), first])

    return run


def _advanced(old: np.ndarray, new: np.ndarray, gradient: np.ndarray, reg: float, pairs: int):
    """Rows ``coefficients, gradient, steps, changes of gradient`` after a step."""
    gradient = gradient + reg * new
    steps = np.concatenate([old[:, 2 : 2 + pairs], (new - old[:, 0])[:, None]], axis=1)
    turns = np.concatenate([old[:, 2 + pairs :], (gradient - old[:, 1])[:, None]], axis=1)
    return np.concatenate(
        [new[:, None], gradient[:, None], steps[:, -MEMORY:], turns[:, -MEMORY:]], axis=1
    )


def _products(v: np.ndarray) -> np.ndarray:
    flat = np.moveaxis(v, 1, 0).reshape(v.shape[1], -1)
    return flat @ flat.T


def direction(gram: np.ndarray, pairs: int) -> np.ndarray:
    """Factors of the L-BFGS direction over ``coefficients, gradient, steps, turns``.

    The two loops need dot products only. Steps along which the gradient did not grow are
    left out.
    """
    factors = np.zeros(len(gram))
    factors[1] = -1.0
    usable = [
        (2 + i, 2 + pairs + i) for i in range(pairs) if gram[2 + i, 2 + pairs + i] > LEAST_CURVE
    ]
    shares = {}
    for s, y in reversed(usable):
        shares[s] = factors @ gram[:, s] / gram[s, y]
        factors[y] -= shares[s]
    if usable:
        s, y = usable[-1]
        factors *= gram[s, y] / gram[y, y]
    for s, y in usable:
        factors[s] += shares[s] - factors @ gram[:, y] / gram[s, y]
    return factors


class _Matrix:
    """The vectors as one array by term id on the driver."""

    def __init__(self, blocks: DataFrame, n_terms: int, classes: int, loss):
        self.blocks, self.v, self.loss = blocks, np.zeros((n_terms, 1, classes)), loss

    def evaluate(self, h: np.ndarray, intercepts: np.ndarray):
        return held_pass(self.blocks, h, self.loss(intercepts), ("y",))

    def start(self):
        return self.v[:, 0]

    def gram(self) -> np.ndarray:
        return _products(self.v)

    def candidate(self, factors: np.ndarray) -> np.ndarray:
        return np.einsum("rvc,v->rc", self.v, factors)

    def first(self, h: np.ndarray, gradient: np.ndarray, reg: float) -> None:
        self.v = np.stack([h, gradient + reg * h], axis=1)

    def accept(self, h: np.ndarray, gradient: np.ndarray, reg: float, pairs: int) -> None:
        self.v = _advanced(self.v, h, gradient, reg, pairs)

    def table(self) -> DataFrame:
        return staged(rows_table(self.blocks.sparkSession, self.v[:, 0]), "coefficients")

    def drop(self, h: np.ndarray, gradient: np.ndarray) -> None:
        pass

    def close(self) -> None:
        pass


def _cube(column: pa.Array, classes: int) -> np.ndarray:
    """Vectors of a batch by row, vector and class."""
    return np.asarray(column.flatten()).reshape(len(column), -1, classes)


def _vectors(j: pa.Array, v: np.ndarray, name: str) -> pa.RecordBatch:
    flat = v.reshape(len(v), -1)
    offsets = pa.array(np.arange(len(v) + 1) * flat.shape[1], pa.int32())
    values = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))
    return pa.RecordBatch.from_arrays([j, values], ["j", name])


class _Table:
    """The vectors as a table ``j, v``, one row of all of them for each term."""

    def __init__(self, blocks: DataFrame, terms: DataFrame, classes: int, loss, **bounds):
        self.blocks, self.classes = PlacedBlocks(blocks, ("y",), **bounds), classes
        self.loss = loss
        zeros = F.array(*[F.lit(0.0)] * classes)
        self.v = staged(terms.select("j", zeros.alias("v")), "vectors")

    def evaluate(self, h: DataFrame, intercepts: np.ndarray):
        return self.blocks.run(h, self.classes, self.loss(intercepts))

    def start(self) -> DataFrame:
        return self.v.select("j", F.col("v").alias("h"))

    def gram(self) -> np.ndarray:
        classes = self.classes

        def partial(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    found = _products(_cube(batch.column("v"), classes))
                    total = found if total is None else total + found
            if total is not None:
                at = pa.array(np.arange(total.size))
                yield pa.RecordBatch.from_arrays([at, pa.array(total.ravel())], ["at", "v"])

        sums = self.v.select("v").mapInArrow(partial, "at bigint, v double")
        found = dict(map(tuple, sums.groupBy("at").agg(F.sum("v")).collect()))
        size = round(len(found) ** 0.5)
        return np.array([found[a] for a in range(size * size)]).reshape(size, size)

    def candidate(self, factors: np.ndarray) -> DataFrame:
        classes = self.classes

        def mixed(batches):
            for batch in batches:
                if batch.num_rows:
                    v = np.einsum("rvc,v->rc", _cube(batch.column("v"), classes), factors)
                    yield _vectors(batch.column("j"), v, "h")

        return staged(self.v.mapInArrow(mixed, "j bigint, h array<double>"), "candidate")

    def first(self, h: DataFrame, gradient: DataFrame, reg: float) -> None:
        start = self.v
        self._joined(h, gradient, lambda _, new, g: np.stack([new, g + reg * new], axis=1))
        discard(start, gradient)

    def accept(self, h: DataFrame, gradient: DataFrame, reg: float, pairs: int) -> None:
        old = self.v
        self._joined(h, gradient, lambda old, new, g: _advanced(old, new, g, reg, pairs))
        self.drop(h, gradient)
        discard(old)

    def _joined(self, h: DataFrame, gradient: DataFrame, advance) -> None:
        """A new table of vectors; a term no document bears has no gradient.

        Stored factors shrink (a first one is all zeros), so their files say nothing of
        their size, and no side may be broadcast for it.
        """
        classes = self.classes
        zeros = F.array(*[F.lit(0.0)] * classes)
        rows = (
            self.v.join(h.hint("merge"), "j")
            .join(gradient.select("j", F.col("h").alias("g")).hint("merge"), "j", "left")
            .select("j", "v", "h", F.coalesce("g", zeros).alias("g"))
        )

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    old, new, g = (_cube(batch.column(c), classes) for c in ("v", "h", "g"))
                    yield _vectors(batch.column("j"), advance(old, new[:, 0], g[:, 0]), "v")

        self.v = staged(rows.mapInArrow(run, "j bigint, v array<double>"), "vectors")

    def table(self) -> DataFrame:
        return self.v.select("j", F.slice("v", 1, self.classes).alias("h"))

    def drop(self, h: DataFrame, gradient: DataFrame) -> None:
        """The files of a candidate and of its pass."""
        discard(h, gradient)

    def close(self) -> None:
        self.blocks.close()


def fit_wide(
    rows: DataFrame,
    vocabulary: DataFrame,
    classes: int,
    reg: float = 0.0,
    max_iter: int = 100,
    tol: float = 1e-6,
    apart: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> WideModel:
    """Minimise mean log loss + ``reg`` / 2 times the squared coefficients.

    ``rows`` is :func:`training_rows` with labels 0 .. ``classes`` - 1; the term ids of
    ``vocabulary`` must be 0 .. terms-1. Intercepts are not penalised and are given with
    mean 0. With ``apart`` the loss is the sum of one binary loss for each class against
    all others, -1 is the label of a row of no class, and the intercepts are not centred. The fit ends when a step gains less than ``tol`` of the loss, or cannot.
    """
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("y"), F.max("y")).first()
    if not n or low < (-1 if apart else 0) or high >= classes:
        raise ValueError("rows need labels from 0 to classes - 1")
    n_terms = vocabulary.count()
    blocks = document_blocks(rows, "y")
    loss = _apart_step if apart else _loss_step
    small = n_terms <= max_rows and n_terms * classes * 8 * (2 + 2 * MEMORY) <= max_bytes
    if small:
        space = _Matrix(blocks, n_terms, classes, loss)
    else:
        terms = vocabulary.select(F.col("term_id").alias("j"))
        space = _Table(blocks, terms, classes, loss, max_rows=max_rows, max_bytes=max_bytes)
    try:
        model = _minimise(space, n, classes, reg, max_iter, tol)
    finally:
        space.close()
        discard(blocks)
    if not apart:
        model.intercepts = model.intercepts - model.intercepts.mean()
    return model


def _minimise(space, n: int, classes: int, reg: float, max_iter: int, tol: float) -> WideModel:
    # n times the objective, so that the sums of a pass need no division
    penalty = reg * n

    def evaluate(h, intercepts):
        gradient, found = space.evaluate(h, intercepts)
        return gradient, found[0], float(found[1, 0])

    h, bias = space.start(), np.zeros((1, 1, classes))
    gradient, slope, loss = evaluate(h, bias[0, 0])
    space.first(h, gradient, penalty)
    bias = np.stack([bias[:, 0], slope[None]], axis=1)
    losses, pairs, converged = [loss / n], 0, False
    for _ in range(max_iter):
        squares = space.gram()  # the penalty leaves out the intercepts
        gram = squares + _products(bias)
        factors = direction(gram, pairs)
        descent = factors @ gram[:, 1]
        if descent >= -LEAST_CURVE * max(loss, 1.0):
            converged = True
            break
        step = 1.0 if pairs else min(1.0, 1.0 / np.sqrt(gram[1, 1]))
        for _ in range(HALVINGS):
            mix = step * factors
            mix[0] += 1.0
            h = space.candidate(mix)
            moved = np.einsum("rvc,v->rc", bias, mix)
            gradient, slope, data = evaluate(h, moved[0])
            new = data + penalty / 2 * float(mix @ squares @ mix)
            if new <= loss + ARMIJO * step * descent:
                break
            space.drop(h, gradient)
            step /= 2
        else:
            converged = True
            break
        space.accept(h, gradient, penalty, pairs)
        bias = _advanced(bias, moved, slope[None], 0.0, pairs)
        pairs = min(pairs + 1, MEMORY)
        gain, loss = loss - new, new
        losses.append(loss / n)
        if gain <= tol * abs(loss):
            converged = True
            break
    return WideModel(space.table(), bias[0, 0], losses, converged)


def score_wide(
    weights: DataFrame,
    model: WideModel,
    ids: DataFrame,
    key: str = "id",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``key, scores, prediction`` for each row of ``ids``; a document without known terms
    is judged by the intercepts, and the lowest class wins a tie."""
    classes = len(model.intercepts)
    entries = weights.select(key, F.col("term_id").alias("j"), F.col("weight").alias("x"))
    joined = lookup_join(entries, model.coefficients, "j", "inner", max_rows, max_bytes)
    sums = joined.groupBy(key).agg(
        *[F.sum(F.col("x") * F.col("h")[c]).alias(f"s{c}") for c in range(classes)]
    )
    scores = F.array(
        *[F.coalesce(F.col(f"s{c}"), F.lit(0.0)) + float(b) for c, b in enumerate(model.intercepts)]
    )
    return ids.select(key).join(sums, key, "left").select(
        key, scores.alias("scores"), argmax(scores).alias("prediction")
    )
