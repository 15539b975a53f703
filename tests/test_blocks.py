"""Blocks of documents, and what passes over them leave behind."""

import os
from urllib.parse import urlparse

import pyarrow.parquet as pq

from ticket_topics.operators import blocks as B
from ticket_topics.operators import nmf, wide_classify, wide_lda
from ticket_topics.session import discard, staged, wide_rows


def folder_of(table):
    return urlparse(table.staged_at).path


def left(spark, *names):
    scratch = urlparse(spark.conf.get("spark.checkpoint.dir")).path
    return {n: sum(f.startswith(f"{n}-") for f in os.listdir(scratch)) for n in names}


def documents(spark):
    rows = [([i % 7, 7 + i % 5, 12], [1.0, 2.0, 0.5], float(i % 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "j array<bigint>, x array<double>, y double")
    return docs, spark.range(13).selectExpr("id AS term_id")


def test_large_blocks_are_stored_in_small_groups_of_rows(spark):
    one = "transform(sequence(0, 131071), i -> xxhash64(id, i))"
    docs = spark.range(0, 40, 1, 1).selectExpr(f"{one} AS j", f"transform({one}, v -> v / 7D) AS x")
    blocks = B.document_blocks(docs)
    sizes = [len(r["at"]) for r in blocks.select("at").collect()]
    assert sum(sizes) == 40 << 17 and max(sizes) <= B.BLOCK_CELLS
    in_block = blocks.selectExpr("block", "size(at) AS n").groupBy("block").sum("n").collect()
    assert len(in_block) > 1 and max(r[1] for r in in_block) <= 1 << 21
    files = [f for f in os.listdir(folder_of(blocks)) if f.endswith(".parquet")]
    found = [pq.ParquetFile(os.path.join(folder_of(blocks), f)).metadata for f in files]
    groups = [m.row_group(i).total_byte_size for m in found for i in range(m.num_row_groups)]
    assert max(groups) < 40 << 20
    discard(blocks)


def test_small_batches_make_the_same_blocks(spark):
    docs, _ = documents(spark)
    usual = sorted(map(str, B.document_blocks(docs.coalesce(1)).collect()))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        with wide_rows(spark):
            assert spark.conf.get(key) == "3"
        assert sorted(map(str, B.document_blocks(docs.coalesce(1)).collect())) == usual
    finally:
        spark.conf.set(key, before)
    with wide_rows(spark):
        assert int(spark.conf.get(key)) <= 1 << 10
    assert spark.conf.get(key) == before


def test_discarded_tables_are_gone(spark):
    kept, gone = staged(spark.range(3), "kept"), staged(spark.range(3), "gone")
    discard(gone, None, spark.range(1))
    assert os.path.exists(folder_of(kept)) and not os.path.exists(folder_of(gone))
    assert kept.count() == 3


def test_fits_keep_their_result_alone(spark):
    docs, vocabulary = documents(spark)
    names = ("vectors", "candidate", "block-sums", "topic-weights", "nmf-factor", "document-blocks")
    before = left(spark, *names)
    model = wide_classify.fit_wide(docs, vocabulary, 3, reg=0.01, max_iter=4, max_rows=1, max_bytes=1)
    topics = wide_lda.fit_wide_lda(docs, vocabulary, 2, max_rounds=3, max_rows=1, max_bytes=1)
    factor = nmf.fit_nmf(docs, vocabulary, 2, max_iter=4, tol=0.0, max_rows=1)
    assert model.coefficients.count() == topics.topics.count() == factor.factor.count() == 13
    more = {n: left(spark, n)[n] - before[n] for n in names}
    assert more["vectors"] == more["topic-weights"] == 1 and more["nmf-factor"] <= 2
    # a fit that ends with a pass keeps that one
    assert more["block-sums"] <= 2 and more["candidate"] <= 1 and more["document-blocks"] == 0
