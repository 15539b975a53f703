"""Vocabulary, term counts and TF-IDF weights.

Long form is ``(key, term, tf, ...)``; a row is counted where it lies, so no
document is shuffled to count its words. The ML pipelines give the same weights
as vectors for the estimators.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.arrays import term_frequencies
from ..session import scratch_path, staged
from .joins import lookup_join
from .ranking import number_rows

# The English stop words Spark ML removes by default.
ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's
she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()
)


def ticket_tokens(c: Column, stop_words=ENGLISH_STOP_WORDS, drop_empty=False) -> Column:
    """Lower-cased tokens split at single white space, without stop words."""
    return _without(X.tokenize_ws(c, drop_empty), stop_words)


def dictionary_tokens(c: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Words of two characters or more, without stop words.

    Pass another list for another stop-word convention, or ``()`` for none.
    """
    return _without(X.word_tokens(c), stop_words)


def _without(lowered: Column, stop_words) -> Column:
    """The tokens are lower-case already, so the list alone is lowered."""
    low = sorted({w.lower() for w in stop_words})
    return X.remove_stopwords(lowered, low, case_sensitive=True) if low else lowered


def term_table(df: DataFrame, tokens: Column) -> DataFrame:
    """``term, cnt, df`` of every term: occurrences and documents holding it."""
    return _term_sums(df, term_frequencies(tokens))


def _term_sums(df: DataFrame, counts: Column) -> DataFrame:
    return (
        df.select(F.inline(counts))
        .groupBy("term")
        .agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"))
    )


def build_vocabulary(
    df: DataFrame,
    tokens: Column,
    vocab_size: int | None = None,
    min_df: int = 1,
    max_df: float = 1.0,
    n_docs: int | None = None,
    counted: bool = False,
) -> DataFrame:
    """``term_id, term, cnt, df`` ordered by count, then term.

    ``tokens`` are each row's tokens, or its term frequencies where they are ``counted``.

    Every term is kept unless the caller sets ``vocab_size``. The order is total, so
    the terms at such a cut and their ids do not depend on partitioning.
    """
    terms = _term_sums(df, tokens) if counted else term_table(df, tokens)
    if min_df > 1:
        terms = terms.where(F.col("df") >= min_df)
    if max_df < 1.0:
        limit = max_df * (df.count() if n_docs is None else n_docs)
        terms = terms.where(F.col("df") <= F.lit(limit))
    ranked = number_rows(terms, F.desc("cnt"), F.asc("term"), name="term_id")
    if vocab_size is not None:
        ranked = ranked.where(F.col("term_id") <= vocab_size)
    return ranked.withColumn("term_id", F.col("term_id") - 1)


def counted_texts(df: DataFrame, tokens: Column, *keys: str) -> DataFrame:
    """Stored ``keys`` and the term frequencies ``counts`` of each row, cut into words once
    for the vocabulary and the weights."""
    return staged(df.select(*keys, term_frequencies(tokens).alias("counts")), "counted-texts")


def count_terms(
    df: DataFrame,
    tokens: Column,
    vocabulary: DataFrame,
    *keys: str,
    counted: bool = False,
    summed: bool = False,
    **bounds,
) -> DataFrame:
    """``keys, term, tf`` and the vocabulary's columns; unknown terms are dropped.

    With ``counted``, ``tokens`` are the term frequencies of :func:`counted_texts`. With
    ``summed``, rows of equal ``keys`` are added up first, so that the vocabulary is asked
    once for each term of a key.
    """
    counts = df.select(*keys, F.inline(tokens if counted else term_frequencies(tokens)))
    if summed:
        counts = counts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))
    return lookup_join(counts, vocabulary, "term", how="inner", stored=counted and not summed, **bounds)


def idf(df_col: Column, n_docs: int) -> Column:
    """ln((N+1)/(df+1))"""
    return F.log(F.lit(float(n_docs + 1)) / (df_col + 1))


def smooth_idf(df_col: Column, n_docs: int) -> Column:
    """ln((1+N)/(1+df)) + 1"""
    return idf(df_col, n_docs) + 1


def idf_weights(vocabulary: DataFrame, n_docs: int) -> DataFrame:
    return vocabulary.select(
        "term_id", "term", "df", idf(F.col("df"), n_docs).alias("idf")
    )


def tfidf(
    df: DataFrame, tokens: Column, vocabulary: DataFrame, n_docs: int, key: str = "id", **bounds
) -> DataFrame:
    """``key, term, term_id, tf, weight`` with weight = tf * idf; ``tokens`` and ``bounds``
    as in :func:`count_terms`."""
    rows = count_terms(df, tokens, vocabulary, key, **bounds)
    return rows.select(
        key,
        "term",
        "term_id",
        "tf",
        (F.col("tf") * idf(F.col("df"), n_docs)).alias("weight"),
    )


def tfidf_l2(
    df: DataFrame,
    text: str,
    key: str = "id",
    stop_words=ENGLISH_STOP_WORDS,
    min_df: int = 2,
    max_df: float = 0.95,
    vocabulary: DataFrame | None = None,
    n_docs: int | None = None,
    **bounds,
) -> DataFrame:
    """Smoothed TF-IDF with unit length per document, no vocabulary limit."""
    n = df.count() if n_docs is None else n_docs
    tokens = dictionary_tokens(F.col(text), stop_words)
    counted = vocabulary is None
    if counted:
        df, tokens = counted_texts(df, tokens, key), F.col("counts")
        vocabulary = staged(
            build_vocabulary(df, tokens, None, min_df, max_df, n, counted=True), "vocabulary"
        )
    rows = count_terms(df, tokens, vocabulary, key, counted=counted, **bounds)
    raw = F.col("tf") * smooth_idf(F.col("df"), n)
    rows = rows.select(key, "term", "term_id", "tf", raw.alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return rows.select(
        key, "term", "term_id", "tf", (F.col("_w") / length).alias("weight")
    )


def tfidf_l2_all(df: DataFrame, text: str, key: str = "id", **kwargs) -> DataFrame:
    """:func:`tfidf_l2` over every term: no stop words, no limits."""
    return tfidf_l2(
        df, text, key, stop_words=(), min_df=1, max_df=1.0, **kwargs
    )


def counter_model(vocabulary: DataFrame, tokens: str, output: str) -> CountVectorizerModel:
    """Count vectoriser over a stored vocabulary, index = ``term_id``.

    The terms are written into a saved model as data, so they do not pass
    through Python one by one. A vector model holds its whole vocabulary on every
    node; where that does not fit, choose hashed dimensions or the long form.
    """
    path = scratch_path(vocabulary.sparkSession, "counter-model")
    CountVectorizerModel.from_vocabulary(
        ["-"], inputCol=tokens, outputCol=output
    ).write().save(path)
    ordered = F.sort_array(F.collect_list(F.struct("term_id", "term")))
    vocabulary.agg(ordered["term"].alias("vocabulary")).write.mode("overwrite").parquet(
        f"{path}/data"
    )
    return CountVectorizerModel.load(path)


def weight_vector(vocabulary: DataFrame, weight: Column) -> DenseVector:
    """One weight per term, by ``term_id``; for a vocabulary that fits a model."""
    rows = vocabulary.orderBy("term_id").select(weight.alias("w")).toArrow()
    return DenseVector(rows.column("w").to_numpy())


def fit_vectorizer(
    df: DataFrame,
    text: str,
    vocab_size: int | None = None,
    stop_words=ENGLISH_STOP_WORDS,
    output: str = "features",
    hash_features: int | None = None,
    vocabulary: DataFrame | None = None,
) -> PipelineModel:
    """Tokenizer, stop words, counts over the ordered vocabulary, IDF weights.

    The vocabulary pass also counts the documents of each term, so the IDF needs
    no second pass over the texts; one that was built before can be given. With
    ``hash_features`` terms are hashed into so
    many dimensions instead and no vocabulary is held; terms may then share one.
    """
    if hash_features:
        return Pipeline(
            stages=[
                Tokenizer(inputCol=text, outputCol="words"),
                StopWordsRemover(
                    inputCol="words", outputCol="filtered_words", stopWords=list(stop_words)
                ),
                HashingTF(
                    inputCol="filtered_words", outputCol="raw_features", numFeatures=hash_features
                ),
                IDF(inputCol="raw_features", outputCol=output),
            ]
        ).fit(df)
    n = df.count()
    tokens = ticket_tokens(F.col(text), stop_words)
    vocab = vocabulary
    if vocab is None:
        vocab = staged(build_vocabulary(df, tokens, vocab_size), "vocabulary")
    return PipelineModel(
        stages=[
            Tokenizer(inputCol=text, outputCol="words"),
            StopWordsRemover(
                inputCol="words", outputCol="filtered_words", stopWords=list(stop_words)
            ),
            counter_model(vocab, "filtered_words", "raw_features"),
            ElementwiseProduct(
                inputCol="raw_features",
                outputCol=output,
                scalingVec=weight_vector(vocab, idf(F.col("df"), n)),
            ),
        ]
    )


def fit_unit_vectorizer(
    df: DataFrame,
    text: str,
    vocab_size: int | None = None,
    output: str = "features",
    vocabulary: DataFrame | None = None,
) -> PipelineModel:
    """Word tokens, counts, smoothed IDF and unit length as one pipeline."""
    n = df.count()
    tokens = dictionary_tokens(F.col(text), ())
    vocab = vocabulary
    if vocab is None:
        vocab = staged(build_vocabulary(df, tokens, vocab_size), "vocabulary")
    return PipelineModel(
        stages=[
            RegexTokenizer(
                inputCol=text,
                outputCol="words",
                pattern=X.WORD_TOKEN,
                gaps=False,
                toLowercase=True,
            ),
            counter_model(vocab, "words", "raw_features"),
            ElementwiseProduct(
                inputCol="raw_features",
                outputCol="weighted",
                scalingVec=weight_vector(vocab, smooth_idf(F.col("df"), n)),
            ),
            Normalizer(p=2.0, inputCol="weighted", outputCol=output),
        ]
    )


def vector_entries(vector: Column) -> Column:
    """``array<struct<term_id, weight>>`` of a sparse vector."""
    parts = F.unwrap_udt(vector)
    return F.zip_with(
        parts["indices"],
        parts["values"],
        lambda i, w: F.struct(i.alias("term_id"), w.alias("weight")),
    )


def vocabulary_terms(spark: SparkSession, path: str) -> DataFrame:
    """``term_id, term`` of a saved count vectoriser."""
    saved = spark.read.parquet(f"{path}/data")
    return saved.select(F.posexplode("vocabulary").alias("term_id", "term"))
