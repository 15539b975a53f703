"""The classifier whose coefficients are a table, as large vocabularies get it."""

import random

import pytest

from ticket_topics.operators import classify
from ticket_topics.operators.records import TEXT
from ticket_topics.sources import models
from ticket_topics.streaming import ingest, scoring

THEMES = ["card credit limit visa", "loan house mortgage rate", "theft fraud police stolen"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    texts = [(i % 50 or None, " ".join(rng.choices(THEMES[i % 3].split() + ["a", "pay"], k=9)), i % 3) for i in range(120)]
    texts += [(200, None, 1), (201, "", 2)]
    return spark.createDataFrame(texts, f"id int, {TEXT} string, topic int").repartition(3)


def test_a_row_without_a_label_is_of_no_class(rows, monkeypatch):
    some = rows.selectExpr("id", TEXT, "if(id % 7 = 0, null, topic) AS topic")
    small = classify.train_one_vs_rest(some).scores().collect()
    monkeypatch.setattr(classify, "HELD_BYTES", 0)
    large = classify.train_one_vs_rest(some).scores().collect()
    assert sorted(map(str, large)) == sorted(map(str, small))
    with pytest.raises(ValueError):
        classify.train_classifier(some)


@pytest.mark.parametrize("fit", [classify.train_classifier, classify.train_one_vs_rest])
def test_tables_predict_as_spark_ml(spark, rows, monkeypatch, tmp_path, fit):
    small = fit(rows)
    monkeypatch.setattr(classify, "HELD_BYTES", 0)
    large = fit(rows)
    assert isinstance(large.model, classify.TermClassifier) and large.scored.count() == rows.count()
    words = rows.where(f"{TEXT} <> ''")
    got, want = ([r.prediction for r in classify.score_texts(m.model, words, "id").orderBy(TEXT).collect()] for m in (large, small))
    assert got == want
    models.save_model(large.model, str(tmp_path / "m"))
    again = classify.score_texts(models.load_pipeline(str(tmp_path / "m")), rows, "id")
    once = classify.score_texts(large.model, rows, "id")
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert {r.split: r.n_rows for r in large.scores().collect()} == {r.split: r.n_rows for r in small.scores().collect()}


def test_no_factor_is_broadcast_for_its_small_file(spark):
    from ticket_topics.operators import wide_classify
    from ticket_topics.session import staged

    from .plans import explained

    h = staged(spark.range(500).selectExpr("id AS j", "array(0D, 0D) AS h"), "zeros")
    space = object.__new__(wide_classify._Table)
    space.classes, space.v = 2, h.selectExpr("j", "h AS v")
    seen = []
    staging, wide_classify.staged = wide_classify.staged, lambda df, name: seen.append(explained(df)) or df
    try:
        space.first(h, h, 0.0)
    finally:
        wide_classify.staged = staging
    assert "SortMergeJoin" in seen[0] and "Broadcast" not in seen[0]


def test_tables_score_arriving_texts(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(classify, "HELD_BYTES", 0)
    model = classify.train_classifier(rows).model
    assert isinstance(model, classify.TermClassifier)
    texts = rows.select("id", TEXT)
    texts.limit(0).write.parquet(str(tmp_path / "in"))

    def scored():
        stream = ingest.file_stream(spark, str(tmp_path / "in"), texts.schema, "parquet", max_files=2)
        return scoring.score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "cp"), "id")

    assert scored().count() == 0
    for part in ("id % 2 = 0", "id % 2 <> 0 OR id IS NULL"):
        texts.where(part).write.mode("append").parquet(str(tmp_path / "in"))
        got = scored()
    assert got.columns == ["id", TEXT, "prediction"]
    want = classify.score_texts(model, texts, "id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("most", [1, 200, 1 << 23])
def test_tables_score_by_blocks_without_a_broadcast(spark, rows, monkeypatch, most):
    from ticket_topics.operators import word_blocks

    from .plans import explained

    monkeypatch.setattr(word_blocks, "BLOCK_BYTES", most)
    names = [("fee", 1.0, [2.0, 0.0, -9.0]), ("card", 3.0, [0.0, 1.0, 0.0]), ("", 1.0, [0.0, 0.0, 5.0])]
    known = spark.createDataFrame(names, "term string, w double, h array<double>")
    texts = [(1, "fee card"), (1, "card card"), (None, "pay"), (2, None), (3, "fee  card card"), (4, "FEE fee")]
    rows = spark.createDataFrame(texts, f"id int, {TEXT} string").repartition(2)
    for unit, want in ((False, [0, 1, 1, 2, 1, 0]), (True, [1, 1, 1, 1, 1, 0])):
        # a null text is blank, and a blank ticket token is a term of its own
        model = classify.TermClassifier(known, [0.0, 0.5, 0.0], unit)
        found = classify.score_texts(model, rows, "id")
        plan = explained(found)
        assert "Broadcast" not in plan and "Generate" not in plan
        got = {(r.id, r[TEXT]): int(r.prediction) for r in found.collect()}
        assert [got[i, t or ""] for i, t in texts] == want
    none = classify.TermClassifier(known.limit(0), [0.0, 0.5, 0.0], False)
    assert {r.prediction for r in classify.score_texts(none, rows, "id").collect()} == {1.0}
