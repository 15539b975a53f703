"""Classifier metrics from one confusion table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by=()
) -> DataFrame:
    """Share of rows whose prediction is their label."""
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.groupBy(*by).agg(
        F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_rows")
    )


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by=(),
    weight: str | None = None,
) -> DataFrame:
    """``by, label, prediction, n``; the only pass over the scored rows."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(n.cast("bigint").alias("n"))


def class_counts(matrix: DataFrame, by=()) -> DataFrame:
    """``by, class, support, predicted, hits`` over labels and predictions alike."""
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("support"),
            zero.alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), n).otherwise(zero).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("support"),
            n.alias("predicted"),
            zero.alias("hits"),
        ),
    )
    return (
        matrix.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class; 0 where a ratio has no rows."""
    p = _ratio(F.col("hits"), F.col("predicted"))
    r = _ratio(F.col("hits"), F.col("support"))
    rows = counts.withColumn("precision", p).withColumn("recall", r)
    total = F.col("precision") + F.col("recall")
    return rows.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), total))


def _weighted(c: str) -> Column:
    return F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))


def weighted_metrics(matrix: DataFrame, by=()) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 per group."""
    rows = class_metrics(class_counts(matrix, by))
    return rows.groupBy(*by).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1").alias("f1"),
    )


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    rows = class_metrics(class_counts(matrix))
    per_class = rows.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support"
    )
    total = F.sum("support").alias("support")
    hit_rate = F.try_divide(F.sum("hits"), F.sum("support"))
    overall = rows.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"),
                hit_rate.alias("precision"),
                hit_rate.alias("recall"),
                hit_rate.alias("f1"),
                total,
            ),
            F.struct(
                F.lit("macro avg").alias("class"),
                F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"),
                F.avg("f1").alias("f1"),
                total,
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                _weighted("precision").alias("precision"),
                _weighted("recall").alias("recall"),
                _weighted("f1").alias("f1"),
                total,
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per_class.unionByName(overall)
