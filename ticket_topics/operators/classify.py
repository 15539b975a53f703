"""Topic classifiers on TF-IDF vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, LR_MAX_ITER
from ..functions.arrays import bind
from ..session import discard, staged, wide_rows
from .evaluate import accuracy
from .features import (
    build_vocabulary,
    dictionary_tokens,
    fit_unit_vectorizer,
    fit_vectorizer,
    idf,
    smooth_idf,
    ticket_tokens,
)
from .records import TEXT, fill_null_text
from .splits import hash_split
from .wide_classify import fit_wide
from .word_blocks import counted_blocks, weighted_terms, with_terms

# Spark ML fits on the driver while its vectors (L-BFGS keeps twenty) are within the bound.
HELD_BYTES, FIT_VECTORS = BROADCAST_BYTES, 24


@dataclass
class Trained:
    """A text-to-topic pipeline and its scored training frame."""

    model: PipelineModel | TermClassifier
    scored: DataFrame

    def scores(self) -> DataFrame:
        """Accuracy of both splits from one aggregate."""
        return accuracy(self.scored, by=("split",))


def logistic_regression(max_iter: int = LR_MAX_ITER, **params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="label", maxIter=max_iter, **params
    )


def one_vs_rest(n_train: int, parallelism: int = 4, **params) -> OneVsRest:
    """One L2-penalised binary model per class, C = 1, classes fitted side by side.

    The intercept is not penalised here.
    """
    settings = {"maxIter": 100, "tol": 1e-4, "standardization": False, **params}
    lr = LogisticRegression(regParam=1.0 / n_train, **settings)
    return OneVsRest(
        classifier=lr, featuresCol="features", labelCol="label", parallelism=parallelism
    )


def _numbered(rows: DataFrame, text: str, unit: bool, *keep: str) -> DataFrame:
    """Stored rows with a number and the counts of their terms, cut into words once."""
    tokens = dictionary_tokens(F.col(text), ()) if unit else ticket_tokens(F.col(text))
    return counted_blocks(rows, tokens, text, *keep)


@dataclass
class TermClassifier:
    """A classifier as tables, for vocabularies beyond the driver.

    ``terms``: ``term, w, h`` with the weight of one occurrence and its score for each
    class. ``unit`` documents have length one and consist of words, others of ticket tokens.
    """

    terms: DataFrame
    intercepts: list[float]
    unit: bool

    def predicted(self, rows: DataFrame) -> DataFrame:
        """The numbered rows with ``prediction``; one without known terms is judged by the
        intercepts, and the lowest class wins a tie."""
        intercepts, unit = np.array(self.intercepts), self.unit

        def best(found, owner, place, tf, n):
            h = np.asarray(found.column("h").combine_chunks().flatten()).reshape(-1, len(intercepts))
            scores = np.stack([np.bincount(owner, tf * c[place], n) for c in h.T], axis=1)
            if unit:
                x = tf * found.column("w").to_numpy()[place]
                length = np.sqrt(np.bincount(owner, x * x, n))
                scores = scores / np.where(length > 0, length, np.inf)[:, None]
            return [pa.array((scores + intercepts).argmax(axis=1).astype(np.float64))]

        keep = tuple(c for c in rows.columns if c not in ("_block", "_counts"))
        return with_terms(rows, self.terms.select("term", "w", "h"), best, keep, "prediction double")

    def transform(self, rows: DataFrame, text: str) -> DataFrame:
        """The rows with ``prediction``."""
        return self.predicted(_numbered(rows, text, self.unit, *rows.columns)).drop("_row")

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        kind = "intercepts array<double>, unit boolean"
        own = spark.createDataFrame([(list(self.intercepts), self.unit)], kind)
        own.write.mode("overwrite").parquet(f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermClassifier | None:
        """The saved classifier, or none where there is another model."""
        try:
            own = spark.read.parquet(f"{path}/classifier").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return cls(spark.read.parquet(f"{path}/terms"), list(own["intercepts"]), own["unit"])


def _fit(df, unit, vectorizer, estimator, key, text, train_percent, fit_on, vocab_size, settings):
    """``settings`` are those of :func:`fit_wide`, or none where the dimensions are hashed."""
    rows = hash_split(df, key, train_percent)
    basis = rows if fit_on == "all" else rows.where(F.col("split") == "train")
    if settings is None:
        return _fit_vectors(rows, vectorizer(basis), estimator, key)
    counted = _numbered(rows, text, unit, key, "label", "split")
    known = counted if fit_on == "all" else counted.where(F.col("split") == "train")
    vocabulary = build_vocabulary(known, F.col("_counts"), vocab_size, counted=True)
    vocabulary = staged(vocabulary, "vocabulary")
    train = counted.where(F.col("split") == "train")
    classes = int(train.agg(F.max("label")).first()[0] or 0) + 1
    if vocabulary.count() * classes * 8 * FIT_VECTORS > HELD_BYTES:
        return _fit_terms(counted, known.count(), vocabulary, classes, unit, key, settings)
    return _fit_vectors(rows, vectorizer(basis, vocabulary), estimator, key)


def _fit_vectors(rows, vectors, estimator, key) -> Trained:
    # The texts are cut into words once; fitting and scoring read the vectors.
    placed = staged(
        vectors.transform(rows).select(
            key, F.col("label").cast("double").alias("label"), "split", "features"
        ),
        "training-vectors",
    )
    train = placed.where(F.col("split") == "train")
    model = estimator(train).fit(train)
    scored = model.transform(placed).select(
        key, F.col("label").cast("int").alias("label"), "split", "prediction"
    )
    return Trained(PipelineModel(stages=[*vectors.stages, model]), scored)


def _fit_terms(rows, n_docs, vocabulary, classes, unit, key, settings) -> Trained:
    """The same model with its coefficients as a table (:mod:`wide_classify`).

    As Spark ML does for the multinomial one, each term is scaled by its deviation over
    the training rows; the scale is taken out again from the coefficients.
    """
    train = rows.where(F.col("split") == "train")
    if not unit and not train.where(F.col("label").isNull()).isEmpty():
        raise ValueError("a training row has no label")
    n_train = max(train.count(), 1)
    counts = train.select("_row", F.inline("_counts"))
    if unit:
        known = vocabulary.select("term_id", "term", smooth_idf(F.col("df"), n_docs).alias("w"))
    else:
        tf = F.col("tf").cast("double")
        sums = counts.groupBy("term").agg(F.sum(tf).alias("s"), F.sum(tf * tf).alias("s2"))
        spread = (F.col("s2") - F.col("s") * F.col("s") / n_train) / max(n_train - 1, 1)
        used = (F.col("spread") > 0) & (idf(F.col("df"), n_docs) > 0)
        sums = sums.select("term", spread.alias("spread"))
        known = vocabulary.join(sums, "term", "left").select(
            "term_id", "term", F.when(used, 1 / F.sqrt("spread")).otherwise(0.0).alias("w")
        )
    known = staged(known, "term-weights")
    # against the rest a row without a label is of no class
    y = F.coalesce(F.col("label").cast("double"), F.lit(-1.0))
    items = weighted_terms(train.withColumn("y", y), known, "y")
    x = F.col("x")
    if unit:
        length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
        x = bind(length, lambda n: F.transform("x", lambda v: v / n))
    with wide_rows(rows.sparkSession):
        documents = staged(items.select("j", x.alias("x"), "y"), "training-rows")
    fitted = fit_wide(documents, known, classes, **settings(n_train))
    discard(documents)
    scores = F.transform("h", lambda v: v * F.col("w"))
    coefficients = fitted.coefficients.withColumnRenamed("j", "term_id").hint("merge")
    terms = known.join(coefficients, "term_id").select(
        "term", "w", scores.alias("h")
    )
    model = TermClassifier(staged(terms, "classifier"), [float(b) for b in fitted.intercepts], unit)
    scored = model.predicted(rows).select(
        key, F.col("label").cast("int").alias("label"), "split", "prediction"
    )
    return Trained(model, scored)


def train_classifier(
    df: DataFrame,
    key: str = "id",
    text: str = TEXT,
    label: str = "topic",
    train_percent: int = 80,
    fit_on: str = "all",
    vocab_size: int | None = None,
    hash_features: int | None = None,
    max_iter: int = LR_MAX_ITER,
    **params,
) -> Trained:
    """Multinomial logistic regression on TF-IDF of the ticket tokens.

    ``fit_on`` is ``all`` (weights from every row) or ``train``. ``hash_features`` is
    the number of hashed dimensions. A vocabulary whose fit would not be small on the
    driver gives a :class:`TermClassifier`, whose vectors and scores are tables.
    """
    rows = fill_null_text(df.select(key, text, F.col(label).alias("label")), text)
    return _fit(
        rows,
        False,
        lambda d, v=None: fit_vectorizer(d, text, vocab_size, hash_features=hash_features, vocabulary=v),
        lambda _: logistic_regression(max_iter, **params),
        key,
        text,
        train_percent,
        fit_on,
        vocab_size,
        # other settings are Spark ML's alone
        None if hash_features or params else lambda _: {"max_iter": max_iter, "tol": 1e-6},
    )


def train_one_vs_rest(
    df: DataFrame,
    key: str = "id",
    text: str = TEXT,
    label: str = "topic",
    train_percent: int = 75,
    fit_on: str = "all",
    vocab_size: int | None = None,
) -> Trained:
    """One-vs-rest logistic regression on unit-length TF-IDF of all words; of a large
    vocabulary as tables, all classes fitted at once."""
    rows = fill_null_text(df.select(key, text, F.col(label).alias("label")), text)
    return _fit(
        rows,
        True,
        lambda d, v=None: fit_unit_vectorizer(d, text, vocab_size, vocabulary=v),
        lambda train: one_vs_rest(max(train.count(), 1)),
        key,
        text,
        train_percent,
        fit_on,
        vocab_size,
        lambda n: {"reg": 1.0 / n, "max_iter": 100, "tol": 1e-4, "apart": True},
    )


def score_texts(
    model: PipelineModel | TermClassifier, df: DataFrame, *keep: str, text: str = TEXT
) -> DataFrame:
    """``keep, text, prediction`` of unlabelled texts; a null text counts as blank."""
    filled = fill_null_text(df.select(*keep, text), text)
    if isinstance(model, TermClassifier):
        return model.transform(filled, text).select(*keep, text, "prediction")
    return model.transform(filled).select(*keep, text, "prediction")
