import pytest

from ticket_topics.operators import lexicon as L
from ticket_topics.schema import RAW_COMPLAINT

TAGGED = (
    [("cards", "NNS", "card")] * 3
    + [("cards", "NN", "cards")] * 2
    + [("card", "NN", "card"), ("fees", "NNS", "fee"), ("fee", "NN", "fee")]
    + [("ran", "VBD", "run"), ("run", "VB", "run"), ("run", "NN", "run")]
    + [("is", "VBZ", "be")]
)
TEXTS = {
    1: "cards  fees ran unknown",
    2: "",
    3: "   ",
    4: None,
    5: "card fee card",
    6: "unknown only",
    7: "is run",
}


def lexicon(spark):
    return L.induce_lexicon(spark.createDataFrame(TAGGED, "form string, tag string, lemma string"))


def test_most_frequent_tag_ties_to_lower(spark):
    got = {r.form: (r.tag, r.lemma) for r in lexicon(spark).collect()}
    assert got["cards"] == ("NNS", "card")
    assert got["run"] == ("NN", "run")


def test_counted_tokens_give_the_same(spark):
    rows = spark.createDataFrame(TAGGED, "form string, tag string, lemma string")
    counted = rows.groupBy("form", "tag", "lemma").count().withColumnRenamed("count", "n")
    assert sorted(L.induce_lexicon(counted).collect()) == sorted(lexicon(spark).collect())


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
@pytest.mark.parametrize("unknown", [None, "NN"])
def test_lemmas_and_nouns(spark, bounds, unknown):
    df = spark.createDataFrame(list(TEXTS.items()), "id int, complaint_cleaned string")
    out = L.lemmatize_and_tag(df, lexicon(spark), unknown_tag=unknown, **bounds)
    got = {r.id: (r.complaint_lemmatized, r.complaint_pos_filtered) for r in out.collect()}
    word = "unknown" if unknown else ""
    assert got == {
        1: ("card fee run unknown", f"card fee run {word}".strip()),
        2: ("", ""),
        3: ("", ""),
        4: ("", ""),
        5: ("card fee card", "card fee card"),
        6: ("unknown only", "unknown only" if unknown else ""),
        7: ("be run", "run") if not unknown else ("be run", "run"),
    }
    assert {r.id: r.complaint_cleaned for r in out.collect()} == TEXTS


AWKWARD = [
    ("form", "NN", "b"), ("form", "AA", "c"), ("cats", "NNS", "cat"), ("cats", "NNS", "cot"),
    ("dogs", "NN", None), ("none", None, "none"), (None, "NN", "lost"), ("cat", "NN", "cat"),
]


@pytest.mark.parametrize("unknown", [None, "NN"])
def test_both_ways_on_awkward_lexicons_and_ids(spark, unknown):
    """Double and missing ids, two entries of a form, forms without lemma or tag."""
    lexicon_ = spark.createDataFrame(AWKWARD, "form string, tag string, lemma string")
    rows = [(1, "cats dogs"), (1, "form bark"), (1, "cats dogs"), (None, "none x"), (None, "cat"), (2, None)]
    df = spark.createDataFrame(rows, "id int, complaint_cleaned string")
    out = [
        sorted(map(str, L.lemmatize_and_tag(df, lexicon_, unknown_tag=unknown, **bounds).collect()))
        for bounds in ({}, {"max_rows": 0})
    ]
    assert out[0] == out[1] and len(out[0]) == len(rows)


def test_preprocess(spark):
    raw = spark.createDataFrame(
        [
            ("i", "t", "1", 0.0, {"complaint_what_happened": "Cards, FEES! xxxx 12ab"}),
            ("i", "t", "2", 0.0, {"complaint_what_happened": ""}),
        ],
        RAW_COMPLAINT,
    )
    rows = L.preprocess(raw, lexicon(spark)).collect()
    assert len(rows) == 1
    assert rows[0].complaint_cleaned == "cards fees xxxx "
    assert rows[0].complaint_final == "card fee"
