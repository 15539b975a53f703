"""Named stages between the jobs, as Parquet or CSV."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class StageCatalog:
    """Where each stage of each input file lives; readers and writers share it."""

    base: str

    @staticmethod
    def stem(path: str) -> str:
        return posixpath.splitext(posixpath.basename(path.rstrip("/")))[0]

    def preprocessed(self, path: str) -> str:
        return f"{self.base}/preprocessed/{self.stem(path)}"

    def malformed(self, path: str) -> str:
        return f"{self.base}/malformed/{self.stem(path)}"

    def labeled(self, path: str) -> str:
        return f"{self.base}/preprocessed_labeled/{self.stem(path)}"

    def scored(self, path: str) -> str:
        return f"{self.base}/scored/{self.stem(path)}"

    def model(self, name: str) -> str:
        return f"{self.base}/models/{name}_model"

    def run_metrics(self) -> str:
        return f"{self.base}/run_metrics"


def write_parquet(
    df: DataFrame, path: str, partition_by=(), max_records_per_file: int = 0
) -> None:
    """Replace a stage; with ``partition_by`` only the partitions at hand."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic"
        )
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None):
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column; white space is kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """CSV; a blank text comes back as null.

    Texts that span lines need ``multi_line``; each file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def with_lineage(df: DataFrame, name: str = "stage_stem") -> DataFrame:
    """Add the stem of the input each row came from: its file, or the stage
    folder when the file is a part of one."""
    path = F.input_file_name()
    file = F.element_at(F.split(path, "/"), -1)
    folder = F.element_at(F.split(path, "/"), -2)
    last = F.when(file.startswith("part-"), folder).otherwise(file)
    return df.withColumn(name, F.regexp_replace(last, r"\.[^.]*$", ""))
