import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from ticket_topics.functions.arrays import term_frequencies
from ticket_topics.operators import features as FE
from ticket_topics.operators.joins import HOT_PARTS, hot_keys, lookup_join, skew_join
from ticket_topics.plans import queries as Q
from ticket_topics.session import staged

from .plans import explained

WORDS = ["card", "fee", "loan", "bank", "theft", "the", "of", "mortgage", "über", "a1"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 30)))) for i in range(60)]
    rows += [(60, ""), (61, "the of"), (62, "fee  fee card ")]
    return rows, spark.createDataFrame(rows, "id int, text string").repartition(3).cache()


def test_term_frequencies(spark, docs):
    rows, df = docs
    got = df.select("id", term_frequencies(F.split("text", " ")).alias("t")).collect()
    texts = dict(rows)
    for r in got:
        assert {e.term: e.tf for e in r.t or []} == Counter(texts[r.id].split(" "))
    empty = spark.range(1).select(term_frequencies(F.array().cast("array<string>")).alias("t"))
    assert empty.first().t is None


def test_vocabulary_equals_count_vectorizer(docs):
    _, df = docs
    tokens = FE.ticket_tokens(F.col("text"))
    vocab = FE.build_vocabulary(df, tokens).orderBy("term_id").collect()
    ml = CountVectorizer(inputCol="w", outputCol="f").fit(df.select(tokens.alias("w")))
    counts = {r.term: r.cnt for r in vocab}
    assert sorted(ml.vocabulary) == sorted(counts)
    assert [counts[t] for t in ml.vocabulary] == [r.cnt for r in vocab]
    assert [(-r.cnt, r.term) for r in vocab] == sorted((-r.cnt, r.term) for r in vocab)


def test_vocabulary_cut_does_not_depend_on_partitions(docs):
    _, df = docs
    tokens = FE.ticket_tokens(F.col("text"))
    cut = [
        [(r.term_id, r.term) for r in FE.build_vocabulary(df.repartition(n), tokens, 4).orderBy("term_id").collect()]
        for n in (1, 6)
    ]
    assert cut[0] == cut[1] and len(cut[0]) == 4


def test_pipeline_equals_ml_idf_and_long_form(docs):
    _, df = docs
    n = df.count()
    model = FE.fit_vectorizer(df, "text")
    out = model.transform(df)
    ml = IDF(inputCol="raw_features", outputCol="ml").fit(out).transform(out)
    for r in ml.select("features", "ml").collect():
        assert list(r.features.indices) == list(r.ml.indices)
        assert r.features.values == pytest.approx(r.ml.values, abs=1e-12)
    tokens = FE.ticket_tokens(F.col("text"))
    long = FE.tfidf(df, tokens, FE.build_vocabulary(df, tokens), n)
    want = {(r.id, r.term_id): r.weight for r in long.collect()}
    entries = out.select("id", F.inline(FE.vector_entries(F.col("features")))).collect()
    assert {(r.id, r.term_id): r.weight for r in entries} == pytest.approx(want)


def brute_l2(rows, stop, min_df, max_df):
    import re

    docs = {i: Counter(w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in stop) for i, t in rows}
    n = len(rows)
    df = Counter(w for c in docs.values() for w in c)
    keep = {w for w, d in df.items() if min_df <= d <= max_df * n}
    out = {}
    for i, c in docs.items():
        raw = {w: f * (math.log((1 + n) / (1 + df[w])) + 1) for w, f in c.items() if w in keep}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, w): v / norm for w, v in raw.items()})
    return out


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}])
def test_tfidf_l2(docs, bounds):
    rows, df = docs
    got = FE.tfidf_l2(df, "text", max_df=0.6, **bounds)
    want = brute_l2(rows, set(FE.ENGLISH_STOP_WORDS), 2, 0.6)
    assert {(r.id, r.term): r.weight for r in got.collect()} == pytest.approx(want)
    everything = FE.tfidf_l2_all(df, "text", **bounds)
    assert {(r.id, r.term): r.weight for r in everything.collect()} == pytest.approx(
        brute_l2(rows, (), 1, 1.0)
    )


def test_unit_pipeline_equals_long_form(docs):
    rows, df = docs
    out = FE.fit_unit_vectorizer(df, "text").transform(df)
    got = sorted(r.weight for r in out.select(F.inline(FE.vector_entries(F.col("features")))).collect())
    assert got == pytest.approx(sorted(brute_l2(rows, (), 1, 1.0).values()))


def test_hashed_dimensions_are_a_choice(docs):
    _, df = docs
    hashed = FE.fit_vectorizer(df, "text", hash_features=64).transform(df).first().features
    every = FE.fit_vectorizer(df, "text").transform(df).first().features
    terms = FE.build_vocabulary(df, FE.ticket_tokens(F.col("text"))).count()
    assert hashed.size == 64 and every.size == terms


def test_stop_words_are_those_of_spark(spark):
    assert sorted(FE.ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def rows_with_a_hot_key(spark, n=3000):
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 5 < 2, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
    )


def test_lookup_join_both_ways(spark):
    left = rows_with_a_hot_key(spark)
    lookup = spark.range(2000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v")
    )
    known = lookup.unionByName(spark.createDataFrame([("hot", -1)], "key string, v bigint"))
    # a hot key that the dictionary has, and one that it lacks
    for table in (known, lookup):
        for how in ("left", "inner"):
            small = lookup_join(left, table, "key", how)
            large = lookup_join(left, table, "key", how, max_rows=0)
            order = ["id", "key", "v"]
            assert sorted(map(str, small.select(order).collect())) == sorted(
                map(str, large.select(order).collect())
            )


def test_no_task_gets_the_hot_key(spark):
    """The shuffle is on the key, and the rows of 40 % hot and all null keys stay out of it."""
    left = staged(rows_with_a_hot_key(spark, 20_000), "left")
    right = left.where("key <> 'hot'").select("key", F.col("id").alias("v"))
    counts = staged(left.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")), "counts")
    hot = hot_keys(counts, "key")
    assert [r.key for r in hot.collect()] == ["hot"]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew_join(left, right, "key", hot, "inner")
        plan = explained(joined)
        assert "hashpartitioning(key" in plan
        cold = left.where("key IS NOT NULL").join(F.broadcast(hot), "key", "left_anti")
        sizes = [
            r.n
            for r in cold.repartition("key").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        ]
        assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        assert joined.count() == right.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_few(spark):
    for n in (10, 1000):
        counts = spark.range(n).select(F.col("id").alias("key"), F.lit(1).alias("n"))
        assert hot_keys(counts, "key").count() <= HOT_PARTS * 2


def test_texts_are_counted_once(docs, monkeypatch):
    """The vocabulary and the weights of unit length read one stored count of the texts."""
    _, df = docs
    cut = []
    monkeypatch.setattr(FE, "term_frequencies", lambda c: cut.append(1) or term_frequencies(c))
    rows = FE.tfidf_l2(df, "text")
    assert len(cut) == 1
    tokens = FE.dictionary_tokens(F.col("text"))
    vocab = staged(FE.build_vocabulary(df, tokens, None, 2, 0.95, df.count()), "vocabulary")
    again = FE.tfidf_l2(df, "text", vocabulary=vocab)
    assert sorted(rows.collect()) == sorted(again.collect())


def test_counted_texts_give_the_same_weights(docs):
    _, df = docs
    tokens = FE.ticket_tokens(F.col("text"))
    counted = FE.counted_texts(df, tokens, "id")
    vocab = staged(FE.build_vocabulary(counted, F.col("counts"), counted=True), "vocabulary")
    for bounds in ({}, {"max_rows": 0}):
        plain = FE.tfidf(df, tokens, vocab, df.count(), **bounds)
        found = FE.tfidf(counted, F.col("counts"), vocab, df.count(), counted=True, **bounds)
        assert sorted(found.collect()) == sorted(plain.collect())


def test_summed_counts_are_looked_up_once(spark):
    texts = [("de", "a1 fee fee"), ("de", "fee loan"), ("es", "fee"), (None, "loan loan"), (None, "loan")]
    df = spark.createDataFrame(texts, "lang string, text string")
    tokens = FE.ticket_tokens(F.col("text"))
    known = FE.build_vocabulary(df, tokens).where("term <> 'a1'")
    for bounds in ({}, {"max_rows": 0}):
        got = FE.count_terms(df, tokens, known, "lang", summed=True, **bounds)
        want = [("de", "fee", 3, 3), ("de", "loan", 1, 3), ("es", "fee", 1, 3), (None, "loan", 3, 3)]
        rows = [(r.lang, r.term, r.tf, r.df) for r in got.collect()]
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_lang_weights_add_up_before_the_vocabulary(spark, sf):
    rows = Q._lang_weights(spark, sf)
    plan = explained(rows)
    assert plan.index("Join") < plan.index("HashAggregate")
    long = FE.count_terms(
        Q._counted(spark, sf), F.col("counts"), Q._vocabulary(spark, sf), "lang", counted=True
    )
    weight = F.col("tf") * FE.idf(F.col("df"), Q._n_docs(spark, sf))
    want = {(r.lang, r.term): r.w for r in long.groupBy("lang", "term").agg(F.sum(weight).alias("w")).collect()}
    assert {(r.lang, r.term): r.weight for r in rows.collect()} == pytest.approx(want)
