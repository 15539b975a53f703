"""Projections, filters and predicates on complaint records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import SOURCE_FIELDS
from .ranking import number_rows

TEXT = "complaint_what_happened"


def flatten_complaints(raw: DataFrame) -> DataFrame:
    """Nested record to 22 named columns."""
    head = [F.col(f"_{n}").alias(n) for n in ("id", "index", "score", "type")]
    return raw.select(*head, *[F.col(f"_source.{n}").alias(n) for n in SOURCE_FIELDS])


def blank_to_null(df: DataFrame, column: str = TEXT) -> DataFrame:
    return df.withColumn(column, X.blank_to_null(F.col(column).cast("string")))


def drop_null_text(df: DataFrame, column: str = TEXT) -> DataFrame:
    """A plain ``is not null``, which reaches the scan; ``na.drop`` does not."""
    return df.where(F.col(column).isNotNull())


def fill_null_text(df: DataFrame, column: str = TEXT) -> DataFrame:
    return df.na.fill({column: ""})


def with_text(raw: DataFrame) -> DataFrame:
    """Flat records that have a text; blank ones count as missing.

    Same rows as blank-to-null and drop, as predicates the scan can use.
    """
    return drop_null_text(flatten_complaints(raw)).where(F.col(TEXT) != "")


def training_frame(df: DataFrame, key: str = "id", label: str = "topic") -> DataFrame:
    return df.select(key, TEXT, label)


def request_texts(records: DataFrame) -> DataFrame:
    """Text field of each service record, with the record's id."""
    return records.select("id", F.col(f"source.{TEXT}").alias(TEXT))


def head(df: DataFrame, key: str = "id", n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def profile(df: DataFrame, column: str = TEXT) -> DataFrame:
    """Shape of a frame: rows, null texts, blank texts."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(c.isNull()).alias("n_null"),
        F.count_if(c == "").alias("n_blank"),
        F.sum(F.char_length(c)).alias("n_chars"),
    )


def renumber(df: DataFrame, key: str = "id", name: str = "row_id") -> DataFrame:
    """Consecutive numbers from 0 in the order of a unique key."""
    return number_rows(df, F.col(key), name=name).withColumn(name, F.col(name) - 1)
