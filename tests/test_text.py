import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from ticket_topics.functions import text as X
from ticket_topics.operators.features import ENGLISH_STOP_WORDS, ticket_tokens

EDGES = [
    "",
    "   ",
    "!!! ...",
    "XXXX lost my card on XX/XX/2020",
    "xxxxx xxxxxxxx",
    "the of and",
    "fee  fee account2 Über naïve",
    "a ",
    " a",
    "a\n\nb\n",
    "tab\tx\x0by z\u00a0w",
    "12 3rd v2x _9 ab_c don't",
    "²½ x² Ⅷ ٣ ab٣c",
]


def apply(spark, values, rule):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    out = rows.select("i", rule(F.col("c")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def python_clean(s):
    s = re.sub(r"[^\w\s]", "", s.lower())
    return re.sub(r"\w*\d\w*", "", s)


def test_clean_edges(spark):
    assert apply(spark, EDGES, X.clean_text) == [python_clean(s) for s in EDGES]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(st.sampled_from("abzXx019_ .,!?'\n\täßéÑÇ-/@²\u00a0\u2003\u4e2d\u0663"), max_size=60),
        min_size=1,
        max_size=40,
    )
)
def test_clean_equals_python_rule(spark, values):
    assert apply(spark, values, X.clean_text) == [python_clean(s) for s in values]


def test_long_word_without_digit_is_linear(spark):
    word = "a" * 200_000
    assert apply(spark, [word, word + "1"], X.strip_numeric_words) == [word, ""]


def test_tokenize_equals_ml_tokenizer(spark):
    rows = spark.createDataFrame([(v,) for v in EDGES], "c string")
    both = Tokenizer(inputCol="c", outputCol="w").transform(rows)
    for r in both.select("w", X.tokenize_ws(F.col("c")).alias("ours")).collect():
        assert r.w == r.ours


def test_drop_empty(spark):
    assert apply(spark, ["a  b ", ""], lambda c: X.tokenize_ws(c, True)) == [["a", "b"], []]


def test_stop_words_are_sparks(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_remove_stopwords_equals_ml(spark):
    rows = spark.createDataFrame([(v,) for v in EDGES], "c string")
    w = Tokenizer(inputCol="c", outputCol="w").transform(rows)
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(w)
    for r in ml.select("f", ticket_tokens(F.col("c")).alias("ours")).collect():
        assert r.f == r.ours


def test_word_tokens_equal_python(spark):
    got = apply(spark, EDGES, X.word_tokens)
    assert got == [re.findall(r"\b\w\w+\b", s.lower()) for s in EDGES]


@pytest.mark.parametrize(
    "raw, want", [("xxxxxxxx", ""), ("xxxxx", "x"), ("a -PRON- xxxx b", "a   b"), ("xxx", "xxx")]
)
def test_mask(spark, raw, want):
    assert apply(spark, [raw], X.mask_cleanup) == [want]


def test_snake_case(spark):
    names = ["Credit card / Prepaid card", "Theft/Dispute reporting", "__A  b__", "Über-Fee"]
    want = [re.sub(r"[\W_]+", "_", n.lower()).strip("_") for n in names]
    assert apply(spark, names, X.snake_case) == want
