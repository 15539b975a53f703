"""Topic models: LDA, topic assignment, term tables."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import N_TOPICS, TOP_TERMS, TOPIC_SEED, TOPICS
from ..functions.arrays import argmax
from .ranking import top_per_group

def fit_partitions(rows: int) -> int:
    """Partitions of a fit, from the rows alone: few for few rows, and with more rows
    both more partitions and larger ones."""
    return max(1, math.ceil(math.sqrt(rows) / 8))


def fit_lda(
    df: DataFrame,
    key: str = "id",
    features: str = "features",
    k: int = N_TOPICS,
    seed: int = TOPIC_SEED,
    partitions: int | None = None,
    **params,
) -> LDAModel:
    """Online LDA over rows in a fixed place and order.

    The mini-batches are drawn per partition, so the same rows in the same
    ``partitions`` give the same model wherever they were read from, on a cluster of
    any size.
    """
    n = partitions or fit_partitions(df.count())
    placed = (
        df.select(key, features)
        .repartition(n, key)
        .sortWithinPartitions(key)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        return LDA(k=k, seed=seed, featuresCol=features, **params).fit(placed)
    finally:
        placed.unpersist()


def assign_topics(
    df: DataFrame,
    model: LDAModel,
    features: str = "features",
    topic: str = "topic",
    mixture: str = "topicDistribution",
) -> DataFrame:
    """Mixture and most likely topic of every document.

    A document without known terms has an all-zero mixture and lands in topic 0;
    ``has_terms`` tells it apart.
    """
    scored = model.transform(df)
    entries = F.size(F.unwrap_udt(F.col(features))["indices"])
    return (
        scored.withColumn(mixture, vector_to_array(mixture))
        .withColumn(topic, argmax(F.col(mixture)))
        .withColumn("has_terms", entries > 0)
    )


def argmax_topic(df: DataFrame, mixture: str, topic: str = "topic") -> DataFrame:
    return df.withColumn(topic, argmax(F.col(mixture)))


def lda_topic_terms(
    model: LDAModel, vocabulary: DataFrame, n: int = TOP_TERMS
) -> DataFrame:
    """``topic, rank, term, weight``: the strongest terms of every topic."""
    entries = model.describeTopics(n).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("r", "e")
    )
    rows = entries.select(
        "topic",
        (F.col("r") + 1).alias("rank"),
        F.col("e.termIndices").cast("bigint").alias("term_id"),
        F.col("e.termWeights").alias("weight"),
    )
    # topics x n rows decide the broadcast side, whatever the vocabulary's size
    return vocabulary.join(F.broadcast(rows), "term_id").select(
        "topic", "rank", "term", "weight"
    )


def top_terms(
    weights: DataFrame, topic: str = "topic", n: int = TOP_TERMS
) -> DataFrame:
    """Top terms of a long ``topic, term, weight`` table; ties by term."""
    return top_per_group(weights, topic, F.desc("weight"), F.asc("term"), n=n)


def topic_word_matrix(ranked: DataFrame, topic: str = "topic", n: int = TOP_TERMS):
    """One row per topic, columns ``word_1 .. word_n``."""
    wide = ranked.groupBy(topic).pivot("rank", list(range(1, n + 1))).agg(F.first("term"))
    return wide.select(
        topic, *[F.col(str(i)).alias(f"word_{i}") for i in range(1, n + 1)]
    )


def head_per_topic(df: DataFrame, key: str = "id", topic: str = "topic", n: int = 5):
    """First documents of every topic, sorted by topic."""
    return top_per_group(df, topic, F.asc(key), n=n).orderBy(topic, key)


def topic_dimension(df: DataFrame, topics=TOPICS) -> DataFrame:
    """``topic, topic_name``; belongs to the model whose topics it names."""
    return df.sparkSession.createDataFrame(
        [(int(i), name) for i, name in topics], "topic int, topic_name string"
    )


def topic_names(df: DataFrame, topics=TOPICS, topic: str = "topic") -> DataFrame:
    """Add ``topic_name``; null where the id is not in the dimension."""
    dim = topic_dimension(df, topics).withColumnRenamed("topic", topic)
    return df.join(F.broadcast(dim), topic, "left")


def topic_ids(df: DataFrame, topics=TOPICS, name: str = "topic_name") -> DataFrame:
    """Add ``topic``; null where the name is not in the dimension."""
    dim = topic_dimension(df, topics).withColumnRenamed("topic_name", name)
    return df.join(F.broadcast(dim), name, "left")


def label_index(c: Column, labels) -> Column:
    """Position of a value in a fixed list of labels, as int; null if absent."""
    options = F.array(*[F.lit(v) for v in labels])
    at = F.array_position(options, c)
    return F.when(at > 0, (at - 1).cast("int"))
