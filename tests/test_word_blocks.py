"""Lookups by blocks of rows: the same texts whatever the blocks, and no token is shuffled."""

import pytest

from ticket_topics.operators import lexicon as L
from ticket_topics.operators import tagger as T
from ticket_topics.operators import word_blocks as W

from .plans import explained
from .test_lexicon import lexicon
from .test_tagger import sentences, texts_of

ROWS = [
    (1, "cards  fees ran unknown"), (1, "card\tfee card"), (None, "cards is"), (2, None), (3, ""),
    (4, " "), (5, "unknown only"), (None, "ran " * 50), (7, "is run été"),
]


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_lexicon_by_blocks_equals_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(W, "BLOCK_BYTES", most)
    df = spark.createDataFrame(ROWS, "id int, complaint_cleaned string").repartition(3)
    ways = [
        sorted(map(str, L.lemmatize_and_tag(df, lexicon(spark), **b).collect())) for b in ({}, {"max_rows": 0})
    ]
    assert ways[0] == ways[1] and len(ways[0]) == len(ROWS)


@pytest.mark.parametrize("most", [1, 7])
def test_context_by_blocks_equals_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(W, "BLOCK_BYTES", most)
    model = T.fit_tagger(sentences(spark))
    for tagged in (T.add_tags, T.lemmatize_in_context):
        df = texts_of(spark).repartition(3)
        ways = [sorted(map(str, tagged(df, model, **b).collect())) for b in ({}, {"max_rows": 1})]
        assert ways[0] == ways[1]


def test_a_lexicon_without_a_known_form(spark):
    none = spark.createDataFrame([], "form string, tag string, lemma string")
    df = spark.createDataFrame(ROWS, "id int, complaint_cleaned string")
    rows = L.lemmatize_and_tag(df, none, max_rows=-1).collect()
    assert sorted(r.complaint_lemmatized for r in rows if r.id == 5) == ["unknown only"]


def test_no_token_is_shuffled(spark):
    df = spark.createDataFrame(ROWS, "id int, complaint_cleaned string")
    plans = [
        explained(L.lemmatize_and_tag(df, lexicon(spark), max_rows=0)),
        explained(T.lemmatize_in_context(df, T.fit_tagger(sentences(spark)), max_rows=1)),
        explained(T.lemmatize_in_context(df, T.fit_tagger(sentences(spark)))),
    ]
    assert not any("Generate" in p for p in plans)
    assert "Exchange" not in plans[2]


def test_a_block_holds_texts_and_rows_up_to_its_bound(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BYTES", 10)
    df = spark.createDataFrame([("a b c d",)] * 20 + [("",)] * 30, "t string").coalesce(1)
    blocks = W.word_blocks(df, W.F.filter(W.F.split("t", " "), lambda w: w != ""))
    sizes = [r["count"] for r in blocks.groupBy("_block").count().collect()]
    assert sum(sizes) == 50 and max(sizes) <= 10 and len(sizes) >= 11


def test_the_check_looks_a_form_up_once_by_language_and_tag(spark, sf, monkeypatch):
    from ticket_topics.plans import queries as Q

    asked, join = [], Q.lookup_join
    monkeypatch.setattr(Q, "lookup_join", lambda left, *a, **k: asked.append(left) or join(left, *a, **k))
    Q.context_tags_check(spark, sf)
    rows = asked[0].select("lang", "form", "tag")
    assert rows.count() == rows.distinct().count() > 0
