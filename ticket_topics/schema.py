"""Explicit schemas; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of the nested complaint text record.
SOURCE_FIELDS = (
    "tags",
    "zip_code",
    "complaint_id",
    "issue",
    "date_received",
    "state",
    "consumer_disputed",
    "product",
    "company_response",
    "company",
    "submitted_via",
    "date_sent_to_company",
    "company_public_response",
    "sub_product",
    "timely",
    "complaint_what_happened",
    "sub_issue",
    "consumer_consent_provided",
)

# Fields a service record must carry with a value.
REQUIRED_FIELDS = (
    "index",
    "type",
    "id",
    "score",
    "complaint_id",
    "issue",
    "date_received",
    "state",
    "product",
    "company_response",
    "company",
    "submitted_via",
    "date_sent_to_company",
    "timely",
)

DATE_FIELDS = ("date_received", "date_sent_to_company")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SOURCE = _strings(SOURCE_FIELDS)

# Raw complaint as exported: nested, underscored keys.
RAW_COMPLAINT = T.StructType(
    [
        T.StructField("_index", T.StringType()),
        T.StructField("_type", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("_score", T.DoubleType()),
        T.StructField("_source", SOURCE),
    ]
)

# The same record as a request to the scorer.
SERVICE_RECORD = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("source", SOURCE),
    ]
)

FLAT_COMPLAINT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("index", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("type", T.StringType()),
        *SOURCE.fields,
    ]
)

RUN_METRICS = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("p025", T.DoubleType()),
        T.StructField("p975", T.DoubleType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("verdict", T.StringType()),
    ]
)
