"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import bind
from ..session import scratch_path
from ..sources.tables import read_table
from . import (
    bpe,
    exact_dedup,
    multi_index,
    near_dedup,
    packing,
    periodic,
    pii,
    quality,
    spelling,
    token_counts,
    url_filter,
    vptree,
    warc,
)


def op1_vantage_point_trees(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.nearest(read_table(spark, folder, "embeddings"))


URL_RULES = (
    url_filter.Rule(True, "org", "/"),
    url_filter.Rule(False, "example.org", "/es/"),
    url_filter.Rule(False, "example.org", "/en/1"),
    url_filter.Rule(True, "com", "/fr/"),
    url_filter.Rule(False, "com", "/de/"),
)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, folder, "pages"), URL_RULES)
    return judged.select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score"
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = quality.fit(docs, read_table(spark, folder, "labels"))
    return quality.score_quality(docs, model).withColumnRenamed("id", "doc_id")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Only tokens are limited: the other capacities are as wide as the tokens allow."""
    pieces = packing.pack(
        read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans_of(read_table(spark, folder, "documents"))
    spans = F.col("spans")
    counts = [pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.span_text(pii.base_spans(spans)), 256).alias("base_sha256"),
        pii.span_text(spans).alias("spans"),
    )


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(read_table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(read_table(spark, folder, "documents"), path, decoded=True)
    return ids.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every run starts a cache of its own; a lasting one is a parameter of the operator."""
    counts = token_counts.token_counts(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        scratch_path(spark, "token-cache"),
    )
    return counts.withColumnRenamed("id", "doc_id")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archive_round_trip(read_table(spark, folder, "pages"))
    return records.select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_dedup.near_groups(read_table(spark, folder, "documents"))
    return groups.withColumnRenamed("id", "doc_id")


def op11_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    links = multi_index.near_vectors(read_table(spark, folder, "embeddings"))
    return links.withColumnRenamed("id", "vec_id")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents; of those whose crc32 is divisible by ten the words
    from a place on repeat the first words from there, so that long runs occur."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def rewritten(w):
        n = F.size(w).cast("long")

        def placed(a):
            p = F.floor((n - a) / (3 + g % 8)) + 1
            word = F.transform(
                F.sequence(F.lit(0).cast("long"), n - 1),
                lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
            )
            return F.array_join(word, " ")

        return F.when(n > 0, bind(g % n, placed)).otherwise("")

    planted = F.when(h % 10 == 0, bind(words, rewritten)).otherwise(F.col("text"))
    return docs.select("doc_id", planted.alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_periods(read_table(spark, folder, "documents")))
    runs = F.col("runs")
    longest = F.array_min(
        F.transform(
            runs,
            lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")),
        )
    )
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    length, period = -F.col("best.less"), F.col("best.period")
    return found.withColumn("best", longest).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_slips(words: DataFrame) -> DataFrame:
    """``word`` of ``id, word``; where 97 divides the crc32 of both, one letter is missing."""
    h = F.crc32(F.concat_ws(":", F.col("id").cast("string"), "word"))
    at = F.pmod(h, F.length("word")).cast("int")
    rest = F.concat(
        F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word"))
    )
    return words.select(F.when(h % 97 == 0, rest).otherwise(F.col("word")).alias("word"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.words_of(read_table(spark, folder, "documents"))
    return spelling.group_variants(with_planted_slips(words))


QUERIES = {
    "op1_vantage_point_trees": op1_vantage_point_trees,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_token_counts": op8_token_counts,
    "op9_warc": op9_warc,
    "op10_order_minhash": op10_order_minhash,
    "op11_multi_index": op11_multi_index,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}
