import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticket_topics.operators import blocks
from ticket_topics.operators import features as FE
from ticket_topics.operators import nmf as N
from ticket_topics.operators import topics as T
from ticket_topics.sources import models

from .plans import explained

THEMES = [["card", "credit", "visa", "limit"], ["loan", "house", "rate", "mortgage"], ["theft", "fraud", "police", "stolen"]]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(THEMES[i % 3], k=20)), i % 3) for i in range(90)]
    rows.append((90, "", 0))
    return spark.createDataFrame(rows, "id int, text string, theme int").repartition(3).cache()


def test_argmax_ties_and_order(spark):
    rows = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],), ([0.0, 0.0, 0.0],)], "m array<double>")
    assert [r.topic for r in T.argmax_topic(rows, "m").collect()] == [0, 2, 0]


def test_lda_label_after_relabel(spark, planted, tmp_path):
    vectors = FE.fit_vectorizer(planted, "text")
    rows = vectors.transform(planted)
    lda = T.fit_lda(rows, k=3, partitions=4, maxIter=10)
    labeled = T.assign_topics(rows, lda).select("id", "topicDistribution", "topic", "has_terms")
    got = {r.id: r for r in labeled.collect()}
    for r in got.values():
        assert sum(r.topicDistribution) == pytest.approx(1.0 if r.has_terms else 0.0, abs=1e-6)
    models.save_model(lda, str(tmp_path / "lda"))
    again = T.assign_topics(rows, models.load_lda(str(tmp_path / "lda")))
    assert {r.id: r.topic for r in again.collect()} == {i: r.topic for i, r in got.items()}
    models.save_model(vectors.stages[2], str(tmp_path / "tf"))
    words = FE.vocabulary_terms(spark, str(tmp_path / "tf"))
    top = T.lda_topic_terms(lda, words, 4).collect()
    assert len(top) == 12 and {r.term for r in top} <= {w for t in THEMES for w in t} | {""}


def test_lda_is_the_same_whatever_the_input_partitions(spark, planted):
    vectors = FE.fit_vectorizer(planted, "text")
    models_ = [
        T.fit_lda(vectors.transform(planted.repartition(n)), k=3, maxIter=5)
        for n in (1, 5)
    ]
    a, b = (m.topicsMatrix().toArray() for m in models_)
    assert np.array_equal(a, b)


def nmf_rows(planted):
    vocab = FE.staged(
        FE.build_vocabulary(planted, FE.dictionary_tokens(F.col("text")), None), "vocabulary"
    )
    long = FE.tfidf_l2(planted, "text", vocabulary=vocab)
    return vocab, N.document_rows(long)


def test_nmf_finds_planted_topics(planted):
    vocab, docs = nmf_rows(planted)
    fit = N.fit_nmf(docs, vocab, k=3)
    assert all(b <= a + 1e-9 for a, b in zip(fit.losses, fit.losses[1:]))
    h = np.array([r.h for r in fit.factor.collect()])
    assert (h >= 0).all()
    scored = N.nmf_transform(docs, fit.factor)
    assert fit.converged
    labels = N.label_documents(planted.select("id", "theme"), scored).collect()
    assert len(labels) == 91
    for theme in range(3):
        assert len({r.topic for r in labels if r.theme == theme and r.has_terms}) == 1
    assert len({r.topic for r in labels if r.has_terms}) == 3
    assert [r.topic for r in labels if not r.has_terms] == [0]
    top = T.top_terms(N.nmf_term_weights(fit.factor, vocab), n=4).collect()
    assert sorted(sorted(r.term for r in top if r.topic == t) for t in range(3)) == sorted(
        sorted(t) for t in THEMES
    )


def test_nmf_loss_is_the_distance(planted):
    vocab, docs = nmf_rows(planted)
    fit = N.fit_nmf(docs, vocab, k=2, max_iter=40, tol=0.0)
    h = np.zeros((vocab.count(), 2))
    for r in fit.factor.collect():
        h[r.j] = r.h
    w = {r.id: np.array(r.mixture) for r in N.nmf_transform(docs, fit.factor).collect()}
    loss = 0.0
    for r in docs.collect():
        x = np.zeros(len(h))
        x[r.j] = r.x
        loss += float(((x - h @ w[r.id]) ** 2).sum())
    assert loss <= fit.losses[-1] + 1e-6
    assert loss == pytest.approx(fit.losses[-1], rel=1e-3)


def test_nmf_joins_agree(planted):
    vocab, docs = nmf_rows(planted)
    a = N.fit_nmf(docs, vocab, k=3, max_iter=2, tol=0.0)
    b = N.fit_nmf(docs, vocab, k=3, max_iter=2, tol=0.0, max_rows=0)
    assert a.losses == pytest.approx(b.losses) and not a.converged
    left = {r.j: r.h for r in a.factor.collect()}
    right = {r.j: r.h for r in b.factor.collect()}
    assert left.keys() == right.keys()
    for j in left:
        assert left[j] == pytest.approx(right[j], abs=1e-6)
    one = {r.id: r.mixture for r in N.nmf_transform(docs, a.factor).collect()}
    two = {r.id: r.mixture for r in N.nmf_transform(docs, a.factor, max_rows=0).collect()}
    for i in one:
        assert one[i] == pytest.approx(two[i], abs=1e-6)


def test_solver_is_least_squares():
    rng = np.random.default_rng(0)
    h = rng.random((30, 4))
    w = rng.random((6, 4))
    x = w @ h.T
    got = N.solve(x @ h, h.T @ h, 500)
    assert got == pytest.approx(w, abs=1e-4)


def test_names_and_matrix(spark):
    rows = spark.createDataFrame([(0,), (4,), (9,)], "topic int")
    names = {r.topic: r.topic_name for r in T.topic_names(rows).collect()}
    assert names == {0: "Bank account services", 4: "Mortgages/loans", 9: None}
    back = T.topic_ids(T.topic_names(rows).drop("topic"))
    assert sorted((r.topic_name or "", r.topic) for r in back.collect()) == [
        ("", None), ("Bank account services", 0), ("Mortgages/loans", 4),
    ]
    weights = spark.createDataFrame(
        [(0, "b", 1.0), (0, "a", 1.0), (0, "c", 2.0), (1, "z", 1.0)], "topic int, term string, weight double"
    )
    wide = T.topic_word_matrix(T.top_terms(weights, n=2), n=2).orderBy("topic").collect()
    assert [tuple(r) for r in wide] == [(0, "c", "a"), (1, "z", None)]


@pytest.mark.parametrize("held", [True, False])
def test_nmf_pass_equals_dense_products(planted, monkeypatch, held):
    monkeypatch.setattr(blocks, "BLOCK_CELLS", 50)
    vocab, docs = nmf_rows(planted)
    rows = {r.id: (r.j, r.x) for r in docs.collect()}
    n = vocab.count()
    dense = np.zeros((len(rows), n))
    for i, (j, x) in enumerate(rows.values()):
        dense[i, j] = x
    stored = N.document_blocks(docs)
    assert stored.count() > 3
    way = N._Held(stored, vocab) if held else N._Factor(stored, vocab, max_rows=1, max_bytes=1)
    h = way.start(4, 3)
    table = h if held else way._keep(h)
    by_term = np.zeros((n, 4))
    for j, row in enumerate(h) if held else ((r.j, r.h) for r in table.collect()):
        by_term[j] = row
    for inner in (None, by_term.T @ by_term):
        target = dense @ by_term
        w = target if inner is None else N.solve(target, inner, 60)
        step = way.run(h, inner)
        got = np.zeros((n, 4))
        for j, row in enumerate(step.xtw) if held else ((r.j, r.h) for r in step.xtw.collect()):
            got[j] = row
        assert np.allclose(got, dense.T @ w, atol=1e-9)
        assert np.allclose(step.gram, w.T @ w, atol=1e-9)
        assert np.allclose(step.plus, (np.maximum(w, 0) ** 2).sum(0), atol=1e-9)
        assert np.allclose(step.minus, (np.minimum(w, 0) ** 2).sum(0), atol=1e-9)


def test_nmf_pass_does_not_shuffle_the_documents(planted):
    vocab, docs = nmf_rows(planted)
    stored = N.document_blocks(docs)
    assert "Exchange" not in explained(stored.select("x"))
    way = N._Factor(stored, vocab, max_rows=1, max_bytes=1)
    try:
        sent = way.blocks.named.groupBy("block").count().hint("merge")
        plan = explained(way.blocks.blocks.join(sent, "block"))
        above = plan[plan.index("SortMergeJoin") : plan.index("InMemoryTableScan")]
        assert "Exchange" not in above
    finally:
        way.close()
