import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticket_topics.llm import quality as Q
from ticket_topics.sources.tables import read_table

from .frames import AWKWARD, awkward, clashing, empty

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.1"
    return read_table(spark, folder, "documents"), read_table(spark, folder, "labels")


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = Q.fit(docs, labels)
    rows = Q.score_quality(docs, model).join(
        labels.select(F.col("doc_id").alias("id"), "quality"), "id"
    )
    held = [r for r in rows.collect() if r.held_out]
    assert all(zlib.crc32(str(r.id).encode()) % 5 == 0 for r in held)
    assert len(held) > 500
    for label in (0, 1):
        right = [r.predicted == label for r in held if r.quality == label]
        assert sum(right) / len(right) > 0.97


def test_scores_are_votes_of_the_nearest(tables):
    docs, labels = tables
    model = Q.fit(docs, labels, per_class=100)
    texts = [r.text for r in docs.limit(50).collect()] + [""]
    counts = np.stack([Q.count_terms(t) for t in texts])
    got = model.scores(counts)
    for row, score in zip(counts, got, strict=True):
        bag = model.bags(row[None])[0] @ model.projection
        norm = np.linalg.norm(bag)
        alike = model.vectors @ bag / norm if norm > 0 else np.zeros(len(model.labels))
        last = np.sort(alike)[-model.neighbours]
        votes = np.where(alike >= last - Q.TIE, np.maximum(alike, 0), 0)
        want = votes @ model.labels / votes.sum() if votes.sum() > 0 else model.labels.mean()
        assert score == pytest.approx(want, abs=1e-4)


def test_held_out_labels_are_never_read(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn(
        "quality", F.when(Q.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = (Q.fit(docs, t, per_class=60) for t in (labels, flipped))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)
    assert len(a.labels) == 120


def test_awkward_rows(spark, tables):
    model = Q.fit(*tables, per_class=60)
    for df in (awkward(spark), clashing(spark)):
        rows = Q.score_quality(df, model).collect()
        assert sorted(repr(r.id) for r in rows) == sorted(repr(i) for i, *_ in AWKWARD)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert [r.score for r in rows if r.id in (2, 3)] == pytest.approx([0.5, 0.5])
        assert Q.keep_good(df, model).columns == df.columns
    assert Q.score_quality(empty(spark), model).count() == 0
    # labels that are null, unknown, doubled, or of documents that are not there
    odd = spark.createDataFrame(
        [(1, None, None), (4, 7, 0), (5, 1, 0), (5, 0, 0), (999, 1, 0), (None, 1, 1)], LABELS
    )
    learnt = Q.fit(awkward(spark), odd)
    assert set(learnt.labels) <= {0.0}
    unlearnt = Q.fit(awkward(spark), spark.createDataFrame([], LABELS))
    assert {r.score for r in Q.score_quality(awkward(spark), unlearnt).collect()} == {0.5}


def test_long_texts_are_counted_whole():
    text = "some plain words and THEN SOME! " * 80_000
    assert Q.count_terms(text)[: Q.TRIGRAMS].sum() >= len(text) - 10
    assert Q.count_terms("x" * (3 << 20))[: Q.TRIGRAMS].sum() >= (3 << 20) - 10


def test_the_default_sample_is_a_thousand_of_each_label(tables):
    docs, labels = tables
    learnt = labels.where(Q.fold("doc_id") != 0).join(docs.select("doc_id"), "doc_id", "left_semi")
    known = {r["quality"]: r["count"] for r in learnt.groupBy("quality").count().collect()}
    model = Q.fit(docs, labels)
    for label in (0, 1):
        assert (model.labels == label).sum() == min(1000, known[label])
    assert max(known.values()) > 1000
