"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.classify import TermClassifier


def save_model(model, path: str) -> None:
    if isinstance(model, TermClassifier):
        model.save(path)
        return
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel | TermClassifier:
    tables = TermClassifier.load(SparkSession.active(), path)
    return tables or PipelineModel.load(path)


def load_lda(path: str) -> LocalLDAModel:
    return LocalLDAModel.load(path)


def save_table(df: DataFrame, path: str) -> None:
    """A model that is a table (lexicon, vocabulary, NMF factor)."""
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
