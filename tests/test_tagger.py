"""The context tagger against every sequence of tags."""

import itertools
import math
import random

import numpy as np
import pytest

from ticket_topics.operators import tagger as T

TOKENS = "tokens array<struct<form: string, tag: string, lemma: string>>"


def best_path(scores, transitions):
    """The best sequence of tags and its score, by trying all."""
    kinds = scores.shape[1]
    best = (-math.inf, None)
    for path in itertools.product(range(kinds), repeat=len(scores)):
        total = transitions[-1, path[0]] + scores[0, path[0]]
        for i in range(1, len(path)):
            total = total + transitions[path[i - 1], path[i]] + scores[i, path[i]]
        if total > best[0]:
            best = (total, path)
    return best


@pytest.mark.parametrize("kinds", [1, 2, 4])
def test_viterbi_equals_all_paths(kinds):
    rng = np.random.default_rng(kinds)
    transitions = np.log(rng.dirichlet(np.ones(kinds), kinds + 1))
    lengths = rng.integers(0, 7, 40)
    scores = rng.normal(size=(lengths.sum(), kinds))
    found = T.viterbi(scores, lengths, transitions)
    ends = np.cumsum(lengths)
    for n, end in zip(lengths, ends, strict=True):
        if n:
            assert tuple(found[end - n : end]) == best_path(scores[end - n : end], transitions)[1]


def test_viterbi_of_long_and_no_texts():
    transitions = np.log(np.array([[0.9, 0.1], [0.1, 0.9], [0.5, 0.5]]))
    scores = np.zeros((50_000, 2))
    scores[0, 1] = 1.0
    assert T.viterbi(scores, np.array([0, 50_000, 0]), transitions).tolist() == [1] * 50_000
    assert len(T.viterbi(np.empty((0, 2)), np.array([0, 0]), transitions)) == 0
    assert len(T.viterbi(np.empty((0, 2)), np.array([], dtype=np.int64), transitions)) == 0


def sentences(spark):
    """"the fish" is a noun, "to fish" a verb; unknown words in -ing are verbs."""
    texts = [
        "the/DT fish/NN swims/VB", "the/DT boat/NN swims/VB", "to/TO fish/VB", "to/TO swim/VB",
        "the/DT old/JJ fish/NN", "to/TO boat/VB the/DT fish/NN", "the/DT swim/NN",
        "walking/VB the/DT dog/NN", "singing/VB the/DT song/NN", "running/VB", "the/DT cat/NN",
    ]
    rows = [
        ([(w.split("/")[0], w.split("/")[1], w.split("/")[0].removesuffix("s")) for w in t.split()],)
        for t in texts
    ]
    return spark.createDataFrame([*rows, ([],), (None,), ([(None, "NN", "x"), ("x", None, "x")],)], TOKENS)


def tags_of(df):
    return {r["id"]: r["tags"] for r in df.collect()}


def texts_of(spark):
    rows = [
        (1, "the fish"), (2, "to fish"), (3, "to fish the fish"), (4, None), (5, ""), (6, "  "),
        (7, "the dogs jumping"), (8, "fish"), (9, "the zzz"), (10, "é"), (1, "the fish"),
        (11, "the fish " * 3000),
    ]
    return spark.createDataFrame(rows, "id int, complaint_cleaned string")


def test_the_same_form_gets_the_tag_of_its_place(spark):
    model = T.fit_tagger(sentences(spark))
    found = tags_of(T.add_tags(texts_of(spark), model))
    assert found[1] == ["DT", "NN"] and found[2] == ["TO", "VB"]
    assert found[3] == ["TO", "VB", "DT", "NN"]
    assert found[4] == found[5] == found[6] == []
    assert found[7][0] == "DT" and found[7][2] == "VB"
    assert found[9] == ["DT", "NN"] and len(found[11]) == 6000


def test_both_ways_tag_alike(spark, monkeypatch):
    model = T.fit_tagger(sentences(spark))
    small = tags_of(T.add_tags(texts_of(spark), model))
    assert tags_of(T.add_tags(texts_of(spark), model, max_rows=1)) == small
    monkeypatch.setattr(T, "CELLS", 8)
    assert tags_of(T._by_join(texts_of(spark), model, "complaint_cleaned", "tags", 1, 1)) == small


def test_both_ways_keep_columns_that_are_never_null(spark):
    model = T.fit_tagger(sentences(spark))
    named = "transform(split(complaint_cleaned, ' '), w -> named_struct('form', w, 'tag', 'X')) AS tokens"
    rows = texts_of(spark).where("id IN (1, 2, 3)").selectExpr("*", "1 AS one", named)
    small, large = (T.add_tags(rows, model, max_rows=n) for n in (100, 1))
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


def test_texts_equal_all_paths_under_the_counted_model(spark):
    model = T.fit_tagger(sentences(spark))
    forms = {r["form"]: r["scores"] for r in model.forms.collect()}
    ends = {r["suffix"]: r["scores"] for r in model.suffixes.collect()}
    rng = random.Random(4)
    pool = [*forms, "dreaming", "xs", "dog"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, complaint_cleaned string")
    found = tags_of(T.add_tags(df, model))
    for i, text in enumerate(texts):
        scores = []
        for w in text.split():
            suffixes = [w[len(w) - k :] for k in range(min(T.SUFFIX, len(w)), -1, -1)]
            scores.append(forms.get(w) or next(ends[e] for e in suffixes if e in ends))
        path = best_path(np.array(scores), model.transitions)[1]
        assert found[i] == [model.tags[k] for k in path]


def test_model_is_a_distribution(spark):
    model = T.fit_tagger(sentences(spark))
    assert np.allclose(np.exp(model.transitions).sum(axis=1), 1)
    total = np.zeros(len(model.tags))
    for r in model.forms.collect():
        total += np.exp(np.maximum(r["scores"], -700))
    assert np.allclose(total, 1)


def test_counts(spark):
    pairs = {(r.previous, r.tag): r.n for r in T.tag_bigrams(sentences(spark).limit(11)).collect()}
    assert pairs["DT", "NN"] == 7 and pairs[None, "TO"] == 3 and pairs["VB", "DT"] == 3
    forms = {(r.form, r.tag): (r.lemma, r.n) for r in T.tag_forms(sentences(spark).limit(11)).collect()}
    assert forms["fish", "NN"] == ("fish", 3) and forms["swims", "VB"] == ("swim", 2)


def test_lemmas_and_nouns_in_context(spark):
    model = T.fit_tagger(sentences(spark))
    for bounds in ({}, {"max_rows": 1}):
        rows = T.lemmatize_in_context(texts_of(spark), model, **bounds).collect()
        found = {r["id"]: (r["complaint_lemmatized"], r["complaint_pos_filtered"]) for r in rows}
        assert found[3] == ("to fish the fish", "fish") and found[4] == found[6] == ("", "")
        assert len(rows) == texts_of(spark).count()
        assert found[8] in {("fish", "fish"), ("fish", "")}


def test_no_tags_is_an_error(spark):
    with pytest.raises(ValueError):
        T.fit_tagger(spark.createDataFrame([], TOKENS))
