"""Complaint records, predictions and runs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.arrays import argmax, bind
from ..functions.hashing import md5_bucket
from ..operators.records import TEXT
from ..operators.topics import label_index
from ..schema import SOURCE_FIELDS
from ..sources.tables import read_table, spread

LANGS = ("de", "en", "es", "fr")
EXPORT_NAME = "ticket-export"
COPY_ID = 10_000_000_000
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# Function words by which a language is guessed, in the order of LANGS.
FUNCTION_WORDS = (
    ("der", "die", "und", "das", "ist", "nicht", "mit", "sich", "auch", "ein", "sch", "ich"),
    ("the", "of", "and", "to", "in", "is", "that", "for", "with", "was", "by", "are"),
    ("el", "los", "las", "que", "del", "por", "una", "con", "para", "como", "se", "es"),
    ("le", "les", "des", "la", "que", "dans", "pour", "pas", "une", "un", "est", "qui"),
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``id, text, lang, source``"""
    docs = spread(read_table(spark, folder, "documents"), "doc_id")
    return docs.select(F.col("doc_id").alias("id"), "text", "lang", "source")


FAULTY_DATES = (
    "12:30:00", "T12:30", "2019", "2019-4-3", "2024-02-10T12:00:00", "2024-02-11 09:15", "10/02/2024",
)


def raw_complaints(spark: SparkSession, folder: str) -> DataFrame:
    """Nested raw complaints: every document with its whole text, and for each document
    labelled toxic or of low quality a second, faulty complaint (``copy`` 1) whose text
    is blank or missing and whose dates have another form. Ids that are no numbers, long
    states and unknown answers occur in both."""
    labels = read_table(spark, folder, "labels")
    docs = spread(read_table(spark, folder, "documents"), "doc_id")
    labelled = docs.join(labels, "doc_id", "left")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    copies = F.when(bad, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = labelled.withColumn("copy", F.explode(copies))
    doc_id, quality = F.col("doc_id"), F.col("quality")
    toxic, lang, source = F.col("toxic"), F.col("lang"), F.col("source")
    faulty = F.col("copy") == 1
    number = F.when(faulty, doc_id + COPY_ID).otherwise(doc_id).cast("string")
    ident = F.when(
        (lang == "de") & quality.isNull(), F.concat(F.lit("doc-"), number)
    ).otherwise(number)
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    forms = F.array(*[F.lit(v) for v in FAULTY_DATES])
    date = (
        F.when(faulty, F.element_at(forms, (doc_id % len(FAULTY_DATES) + 1).cast("int")))
        .when(lang == "es", F.concat(day, F.lit("/02/2024")))
        .otherwise(F.concat(F.lit("2024-02-"), day, F.lit("T12:00:00-05:00")))
    )
    values = {
        "tags": F.when(lang == "fr", F.lit("Older American")),
        "zip_code": F.when(quality.isNotNull(), F.lpad(doc_id.cast("string"), 5, "0")),
        "complaint_id": ident,
        "issue": F.concat(lang, F.lit(" / "), source),
        "date_received": date,
        "state": F.when(toxic == 1, F.upper(source)).otherwise(F.upper(lang)),
        "consumer_disputed": F.lit("N/A"),
        "product": source,
        "company_response": F.when(
            ~((quality == 0) & (toxic == 1)) | quality.isNull(),
            F.lit("Closed with explanation"),
        ),
        "company": F.concat(F.lit("Bank "), source),
        "submitted_via": F.lit("Web"),
        "date_sent_to_company": date,
        "sub_product": lang,
        "timely": F.when(quality == 0, "No")
        .when(quality.isNull() & (source == "src7"), "Maybe")
        .otherwise("Yes"),
        TEXT: F.when(~faulty, F.col("text")).when(toxic == 1, ""),
        "consumer_consent_provided": F.when(toxic == 1, "Consent not provided").otherwise(
            "Consent provided"
        ),
    }
    missing = F.lit(None).cast("string")
    return d.select(
        F.lit(EXPORT_NAME).alias("_index"),
        F.lit("complaint").alias("_type"),
        ident.alias("_id"),
        F.coalesce(quality, F.lit(0)).cast("double").alias("_score"),
        F.struct(*[values.get(f, missing).alias(f) for f in SOURCE_FIELDS]).alias("_source"),
    )


BROKEN_EVERY = 9


def faulty_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value``: the complaints as JSON lines; those whose complaint number is divisible
    by BROKEN_EVERY break off behind their id."""
    raw = raw_complaints(spark, folder)
    line = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    number = F.regexp_extract("_id", r"(\d+)$", 1).cast("bigint")
    broken = F.substring(line, F.lit(1), F.locate(',"_score"', line) - 1)
    return raw.select(
        F.when(number % BROKEN_EVERY == 0, broken).otherwise(line).alias("value")
    )


def service_records(spark: SparkSession, folder: str) -> DataFrame:
    """The same records under the names of the scorer's request."""
    raw = raw_complaints(spark, folder)
    return raw.select(*[F.col(c).alias(c[1:]) for c in raw.columns])


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``id, complaint_what_happened, topic``; the topic is the language."""
    return documents(spark, folder).select(
        "id", F.col("text").alias(TEXT), label_index(F.col("lang"), LANGS).alias("topic")
    )


def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``id, label, prediction, source``: language guessed by function words."""
    def hits(known):
        return F.size(F.filter("words", lambda w: w.isin(*known)))

    docs = documents(spark, folder).withColumn("words", X.word_tokens(F.col("text")))
    return docs.select(
        "id",
        label_index(F.col("lang"), LANGS).alias("label"),
        argmax(F.array(*[hits(known) for known in FUNCTION_WORDS])).alias("prediction"),
        "source",
    )


def source_runs(scored: DataFrame) -> DataFrame:
    """Every source is a run of one experiment, one a day."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("bigint")
    return scored.select(
        F.lit("language_guess").alias("experiment"),
        F.col("source").alias("run_id"),
        F.timestamp_seconds(F.lit(1704067200) + number * 86400).alias("start_time"),
        "id",
        "label",
        "prediction",
    )


def event_topics(events: DataFrame) -> DataFrame:
    """``id, ts, topic`` of an events table or stream, event time as TIMESTAMP."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        label_index(F.col("event_type"), EVENT_TYPES).alias("topic"),
    )


def tagged_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``form, tag, lemma, n``: words of the cleaned documents, counted, with a
    tag by hash of word and language and the lemma without a final ``s``."""
    tokens = documents(spark, folder).select(
        "lang", F.explode(X.words(X.clean_text(F.col("text")))).alias("form")
    )
    counts = tokens.groupBy("form", "lang").agg(F.count(F.lit(1)).alias("n"))
    noun = md5_bucket("tag", 100, F.col("form"), F.col("lang")) < 40
    return counts.select(
        "form",
        F.when(noun, "NN").otherwise("XX").alias("tag"),
        F.regexp_replace("form", "s$", "").alias("lemma"),
        "n",
    )


def tagged_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """``id, lang, complaint_cleaned, tokens``: every document as one tagged sentence.

    Function words are DT. A word of an even number of letters is NN behind one of them
    and VB elsewhere, so its tag depends on its place; other words are NN.
    """
    known = [w for words in FUNCTION_WORDS for w in words]
    cleaned = documents(spark, folder).select(
        "id", "lang", X.clean_text(F.col("text")).alias("complaint_cleaned")
    )
    def tagged(words):
        def token(form, i):
            behind = (i > 0) & F.coalesce(F.get(words, i - 1).isin(*known), F.lit(False))
            tag = (
                F.when(form.isin(*known), "DT")
                .when((F.length(form) % 2 == 0) & ~behind, "VB")
                .otherwise("NN")
            )
            return F.struct(
                form.alias("form"), tag.alias("tag"), F.regexp_replace(form, "s$", "").alias("lemma")
            )

        return F.transform(words, token)

    words = X.words(F.coalesce("complaint_cleaned", F.lit("")))
    return cleaned.withColumn("tokens", bind(words, tagged))
