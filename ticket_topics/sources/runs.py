"""Append-only table of run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RUN_METRICS
from ..session import staged


def append_run(rows: DataFrame, path: str) -> None:
    """Add the metric rows of a run; columns not there yet are written as null.

    A run has a partition of its own, so writing it again replaces it and leaves
    the other runs alone. ``rows`` may be derived from the same table.
    """
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in RUN_METRICS.fields
    ]
    (
        staged(rows.select(*columns), "run-metrics")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment", "run_id")
        .parquet(path)
    )


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    runs = spark.read.schema(RUN_METRICS).parquet(path)
    runs = runs.select(*RUN_METRICS.fieldNames())
    return runs if experiment is None else runs.where(F.col("experiment") == experiment)
