"""Parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(table: DataFrame, key: str) -> DataFrame:
    """Use all cores for a stored table of fewer splits than cores.

    A large table has more splits than cores and stays as it is. Give the bare scan:
    its splits are known from the files, without running anything.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table
