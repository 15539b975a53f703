"""Counters and rates over a stream of predictions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RATE_WINDOW_SECONDS, TOPICS, WATERMARK
from ..operators.monitor import with_all_topics


def count_batches(predictions: DataFrame, path: str, checkpoint: str) -> None:
    """Count what has arrived per topic and batch into a table, and stop.

    A batch writes a partition of its own and replaces it when it is tried again, so a
    restart neither loses nor doubles counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        predictions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_counters(
    predictions: DataFrame, path: str, checkpoint: str, topics=TOPICS
) -> DataFrame:
    """``topic, metric_name, n`` after all files so far; unseen topics count 0.

    ``path`` holds the counts of every batch and belongs to ``checkpoint``; a call
    without new files finds the counts of those before.
    """
    count_batches(predictions, path, checkpoint)
    spark = predictions.sparkSession
    counts = spark.read.schema("topic int, n bigint").parquet(path)
    return with_all_topics(counts.groupBy("topic").agg(F.sum("n").alias("n")), topics)


def stream_rates(
    predictions: DataFrame,
    ts: str = "ts",
    window_seconds: int = RATE_WINDOW_SECONDS,
    slide_seconds: int = 60,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Sliding rates per topic; a window is emitted once, after the watermark
    has passed its end. ``ts`` must be TIMESTAMP."""
    counts = (
        predictions.withWatermark(ts, watermark)
        .groupBy(
            F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds"), "topic"
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "topic",
        "n",
        (F.col("n") / F.lit(float(window_seconds))).alias("rate"),
    )


def closed_windows(
    rates: DataFrame, last: datetime, watermark: str = WATERMARK
) -> DataFrame:
    """Batch windows a stream has emitted once it saw everything up to ``last``."""
    return rates.where(F.col("window_end") <= F.lit(last) - F.expr(f"interval {watermark}"))
