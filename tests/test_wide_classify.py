"""The table classifier against Spark ML and a dense fit."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from ticket_topics.operators import blocks
from ticket_topics.operators import wide_classify as W

LONG = "id bigint, term_id bigint, weight double"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(150):
        label = i % 3
        own = range(label * 6, label * 6 + 8)
        terms = sorted(rng.sample([*own, *range(20)], 5))
        rows += [(i, t, rng.random() + 0.2) for t in set(terms)]
        labels.append((i, label if rng.random() < 0.9 else (label + 1) % 3))
    labels += [(900, 0), (901, None)]
    weights = spark.createDataFrame(rows, LONG)
    labels = spark.createDataFrame(labels, "id bigint, label int")
    vocabulary = spark.createDataFrame([(j,) for j in range(24)], "term_id bigint")
    return weights, labels, vocabulary


def matrix(model, terms, classes):
    out = np.zeros((terms, classes))
    for r in model.coefficients.collect():
        out[r["j"]] = r["h"]
    return out


def ml_fit(spark, weights, labels, reg):
    found = {}
    for r in weights.collect():
        found.setdefault(r["id"], {})[r["term_id"]] = r["weight"]
    rows = [
        (float(r["label"]), Vectors.sparse(24, found.get(r["id"], {})))
        for r in labels.collect()
        if r["label"] is not None
    ]
    lr = LogisticRegression(
        regParam=reg, standardization=False, family="multinomial", maxIter=500, tol=1e-12
    )
    return lr.fit(spark.createDataFrame(rows, ["label", "features"]))


def test_both_ways_take_the_same_steps(spark, table, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_CELLS", 200)
    weights, labels, vocabulary = table
    rows = W.training_rows(weights, labels)
    one = W.fit_wide(rows, vocabulary, 3, reg=0.02, max_iter=4)
    two = W.fit_wide(rows, vocabulary, 3, reg=0.02, max_iter=4, max_rows=1, max_bytes=1)
    assert np.allclose(matrix(one, 24, 3), matrix(two, 24, 3), atol=1e-9)
    assert np.allclose(one.intercepts, two.intercepts, atol=1e-9)
    assert np.allclose(one.losses, two.losses, atol=1e-9)


def test_equals_spark_ml(spark, table):
    weights, labels, vocabulary = table
    rows = W.training_rows(weights, labels)
    model = W.fit_wide(rows, vocabulary, 3, reg=0.02, max_iter=100, tol=1e-12)
    want = ml_fit(spark, weights, labels, 0.02)
    assert np.allclose(matrix(model, 24, 3), want.coefficientMatrix.toArray().T, atol=1e-4)
    intercepts = want.interceptVector.toArray()
    assert np.allclose(model.intercepts, intercepts - intercepts.mean(), atol=1e-4)
    assert model.converged
    assert all(b <= a for a, b in zip(model.losses, model.losses[1:], strict=False))


def test_scores_and_documents_without_terms(spark, table):
    weights, labels, vocabulary = table
    model = W.fit_wide(W.training_rows(weights, labels), vocabulary, 3, reg=0.01)
    small = W.score_wide(weights, model, labels).collect()
    large = W.score_wide(weights, model, labels, max_rows=1).collect()
    assert sorted(map(str, small)) == sorted(map(str, large)) and len(small) == 152
    h = matrix(model, 24, 3)
    sums = {}
    for r in weights.collect():
        sums[r["id"]] = sums.get(r["id"], 0) + r["weight"] * h[r["term_id"]]
    by_id = {r["id"]: r for r in small}
    for i, row in by_id.items():
        score = sums.get(i, np.zeros(3)) + model.intercepts
        assert np.allclose(row["scores"], score) and row["prediction"] == int(score.argmax())
    right = sum(by_id[r["id"]]["prediction"] == r["label"] for r in labels.collect() if r["id"] < 900)
    assert right > 75  # a class holds 50 of the 150


def test_labels_are_checked(spark, table):
    weights, labels, vocabulary = table
    rows = W.training_rows(weights, labels)
    with pytest.raises(ValueError):
        W.fit_wide(rows, vocabulary, 2)
    with pytest.raises(ValueError):
        W.fit_wide(rows.limit(0), vocabulary, 3)


def test_direction_is_the_two_loops():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(7, 7))
    hessian = a @ a.T + np.eye(7)
    steps = rng.normal(size=(4, 7))
    turns = steps @ hessian
    g = rng.normal(size=7)
    v = np.vstack([np.zeros(7), g, steps, turns])
    factors = W.direction(v @ v.T, 4)
    q, alphas = -g.copy(), []
    for s, y in zip(steps[::-1], turns[::-1], strict=True):
        alphas.append(s @ q / (s @ y))
        q -= alphas[-1] * y
    q *= steps[-1] @ turns[-1] / (turns[-1] @ turns[-1])
    for s, y, al in zip(steps, turns, alphas[::-1], strict=True):
        q += s * (al - y @ q / (s @ y))
    assert np.allclose(factors @ v, q)
