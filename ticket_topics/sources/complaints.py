"""Complaint records from files and from memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.records import TEXT
from ..schema import RAW_COMPLAINT
from .json_ranges import CORRUPT, read_json_records


def read_complaints(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    schema: StructType = RAW_COMPLAINT,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Nested complaints from JSON lines or one-line arrays.

    An array printed over several lines, or on one very long line, needs ``multi_line``;
    such a file is read in byte ranges by many tasks. ``mode`` is that of Spark's reader
    of lines. A malformed record becomes a row of nulls: :func:`read_checked_complaints`
    tells it apart.
    """
    if multi_line and mode == "PERMISSIVE":
        return read_json_records(spark, path, schema, "array").select(*schema.fieldNames())
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .json(path)
    )


def read_checked_complaints(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, schema: StructType = RAW_COMPLAINT
) -> DataFrame:
    """The same with ``file, offset, corrupt_record`` of every record."""
    found = read_json_records(spark, path, schema, "array" if multi_line else "lines")
    return found.select(*schema.fieldNames(), "file", "offset", CORRUPT)


def rows_to_frame(
    spark: SparkSession, rows: dict | list[dict], schema: StructType | str = f"{TEXT} string"
) -> DataFrame:
    """One record or a list of them as a frame; all-null columns keep their type."""
    return spark.createDataFrame([rows] if isinstance(rows, dict) else rows, schema)
