"""Token counts kept in a digest cache.

The cache is a Parquet table ``digest, tokenizer, n_tokens``: the SHA-256 of a
normalised text, the SHA-256 of the tokenizer file and the count. Texts are joined
with it by digest; each distinct text that is missing is encoded once, and its count
is appended. Texts travel compressed and once per task and digest, so a text that
holds a third of all rows moves as one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, skew_join
from ..session import staged
from .common import keyed_texts, slices

CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens bigint"
SEEN_DIGESTS = 200_000  # digests a task remembers before it starts anew


@lru_cache(maxsize=2)
def counter(path: str):
    """Function from texts to token counts, loaded once per Python worker."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [
        len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)
    ]


def tokenizer_digest(path: str) -> bytes:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).digest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; a cache that was never written is empty.

    A digest that two jobs appended at the same time counts once.
    """
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)
    return found.groupBy("digest", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``digest, packed``: every distinct text of a task once, compressed."""
    seen: set[bytes] = set()
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in slices(batches, "text"):
        digests = batch.column("digest").to_pylist()
        fresh = []
        for i, digest in enumerate(digests):
            if digest not in seen:
                seen.add(digest)
                fresh.append(i)
        texts = batch.column("text").take(pa.array(fresh, pa.int64())).to_pylist()
        packed = [squeeze(t.encode()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([digests[i] for i in fresh], pa.binary()), pa.array(packed, pa.binary())],
            ["digest", "packed"],
        )
        if len(seen) > SEEN_DIGESTS:
            seen.clear()


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        unpack = zstandard.ZstdDecompressor().decompress
        last = None
        for batch in slices(batches, "packed"):
            digests, texts = [], []
            for digest, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest != last:  # copies of other tasks lie side by side
                    digests.append(digest)
                    texts.append(unpack(packed).decode())
                last = digest
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(count(texts), pa.int64())],
                ["digest", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    path: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit``, one row per input row.

    ``path`` is the tokenizer file, ``cache`` the folder of the stored counts, which
    all executors share. The only normalisation is that a null text is empty (both
    have no token), as any other could change a count. Null and repeated ids stay as
    they are; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_col, text_col).withColumn(
        "digest", F.unhex(F.sha2("text", 256))
    )
    rows = staged(
        texts.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
        "text-digests",
    )
    version = F.lit(tokenizer_digest(path))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version)
    packed = texts.select("digest", "text").mapInArrow(
        _packed, "digest binary, packed binary"
    )
    misses = packed.join(known, "digest", "left_anti")
    fresh = (
        misses.repartition("digest")
        .sortWithinPartitions("digest")
        .mapInArrow(_counted(path), "digest binary, n_tokens bigint")
    )
    fresh.select("digest", version.alias("tokenizer"), "n_tokens").write.mode("append").parquet(
        cache
    )
    counts = read_cache(spark, cache).where(F.col("tokenizer") == version)
    sizes = staged(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "digest-counts")
    joined = skew_join(
        rows, counts.select("digest", "n_tokens"), "digest", hot_keys(sizes, "digest"), "inner"
    )
    return joined.select(
        "id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
