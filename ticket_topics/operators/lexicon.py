"""Lemmas and nouns by lexicon joins.

The quality of the result is that of the lexicon given: a table of word forms
with their most frequent tag and lemma.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import BROADCAST_BYTES, BROADCAST_ROWS
from ..functions import text as X
from ..session import staged
from .joins import is_small
from .records import TEXT, with_text
from .word_blocks import found_places, split_words, with_found, word_blocks

NOUN = "NN"


def induce_lexicon(tagged: DataFrame) -> DataFrame:
    """Most frequent (tag, lemma) of every form; ties go to the lower tag, lemma.

    ``tagged`` has ``form, tag, lemma`` and, where tokens are already counted, ``n``.
    """
    n = F.sum("n") if "n" in tagged.columns else F.count(F.lit(1))
    counts = tagged.groupBy("form", "tag", "lemma").agg(n.alias("n"))
    best = counts.groupBy("form").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), "tag", "lemma")).alias("best")
    )
    return best.select(
        "form", F.col("best.tag").alias("tag"), F.col("best.lemma").alias("lemma")
    )


def compile_lexicon(lexicon: DataFrame) -> DataFrame:
    """``form, lemma, lemma_tag``, one row per form: the tag a lemma has as a word of
    its own.

    Of several entries of a form the one with the lower tag, then lemma, counts. A form
    without a lemma is its own; entries without a form are left out.
    """
    entries = lexicon.where(F.col("form").isNotNull()).select(
        "form", "tag", F.coalesce("lemma", "form").alias("lemma")
    )
    best = entries.groupBy("form").agg(
        F.min(F.struct(F.col("tag").isNull().alias("untagged"), "tag", "lemma")).alias("best")
    )
    single = best.select("form", F.col("best.tag").alias("tag"), F.col("best.lemma").alias("lemma"))
    tags = single.select(F.col("form").alias("lemma"), F.col("tag").alias("lemma_tag"))
    return single.select("form", "lemma").join(tags, "lemma", "left").select(
        "form", "lemma", "lemma_tag"
    )


def lemmatize_and_tag(
    df: DataFrame,
    lexicon: DataFrame,
    column: str = "complaint_cleaned",
    lemmas: str = "complaint_lemmatized",
    nouns: str = "complaint_pos_filtered",
    unknown_tag: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the lemma text and the noun-only text of ``column``.

    Unknown forms stay as they are and get ``unknown_tag``; a text without nouns
    gives ``''``. A lexicon measured to be small is broadcast and looked up where
    the rows lie; a larger one is asked by blocks of rows. Rows need no key, and both
    ways give the same rows.
    """
    compiled = staged(compile_lexicon(lexicon), "lexicon")
    if is_small(compiled, max_rows, max_bytes):
        return _by_broadcast(df, compiled, column, lemmas, nouns, unknown_tag)
    return _by_blocks(df, compiled, column, lemmas, nouns, unknown_tag)


def _by_broadcast(df, compiled, column, lemmas, nouns, unknown_tag):
    table = compiled.select("form", "lemma", _is_noun().alias("noun")).toArrow()
    shared = df.sparkSession.sparkContext.broadcast({"table": table.combine_chunks()})

    @F.arrow_udf("struct<lemmas: string, nouns: string>")
    def look_up(tokens: pa.Array) -> pa.Array:
        known = shared.value
        if "index" not in known:  # built once per worker
            known["index"] = pd.Index(known["table"].column("form").to_pandas())
        coded = tokens.flatten().dictionary_encode()
        found = known["index"].get_indexer(coded.dictionary.to_pandas())
        lengths = np.asarray(pc.list_value_length(tokens), dtype=np.int64)
        texts = _texts(known["table"], coded, found, lengths, unknown_tag)
        return pa.StructArray.from_arrays(texts, names=["lemmas", "nouns"])

    tokens = X.words(F.coalesce(F.col(column), F.lit("")))
    return (
        df.withColumn("_found", look_up(tokens))
        .withColumn(lemmas, F.col("_found.lemmas"))
        .withColumn(nouns, F.col("_found.nouns"))
        .drop("_found")
    )


def _is_noun() -> Column:
    return F.coalesce("lemma_tag", F.lit("")) == NOUN


def _texts(table, coded, found, lengths, unknown_tag) -> list[pa.Array]:
    """Lemma texts and noun texts of coded words, whose distinct ones were ``found`` at rows
    of ``table`` (-1: not at all)."""
    at = pa.array(found, mask=found < 0).take(coded.indices)
    lemma = pc.coalesce(pc.take(table.column("lemma"), at), coded.dictionary_decode())
    noun = pc.fill_null(pc.take(table.column("noun"), at), unknown_tag == NOUN)
    return joined_texts(_flat(lemma), _flat(noun), lengths)


def joined_texts(lemma: pa.Array, noun: pa.Array, lengths: np.ndarray) -> list[pa.Array]:
    """All lemmas of each text, and those of its nouns, joined by spaces."""
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    before = np.concatenate([[0], np.cumsum(noun.to_numpy(zero_copy_only=False))])
    return [
        pc.binary_join(pa.ListArray.from_arrays(pa.array(c, pa.int32()), v), " ")
        for c, v in ((cuts, lemma), (before[cuts], lemma.filter(noun)))
    ]


def _flat(values) -> pa.Array:
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def _by_blocks(df, compiled, column, lemmas, nouns, unknown_tag) -> DataFrame:
    """Each block of rows asks for its words once, and its texts are put together there, so
    rows of one id, or of none, stay apart and no token is shuffled."""
    blocks = word_blocks(df, X.words(F.coalesce(F.col(column), F.lit(""))))
    entries = compiled.select("form", "lemma", _is_noun().alias("noun"))
    kept = [c for c in df.columns if c not in (lemmas, nouns)]

    def run(found: pa.Table, rows: pa.Table) -> pa.Table:
        words, lengths = split_words(rows.column("_words"))
        coded, at = found_places(found, "form", words)
        texts = _texts(found, coded, at, lengths, unknown_tag)
        return pa.table([*[rows.column(c) for c in kept], *texts], [*kept, lemmas, nouns])

    texts = [StructField(c, StringType()) for c in (lemmas, nouns)]
    schema = StructType([*[df.schema[c] for c in kept], *texts])
    return with_found(blocks, entries, "form", run, schema)


def preprocess(raw: DataFrame, lexicon: DataFrame, **bounds) -> DataFrame:
    """Raw nested complaints to flat records with the four text stages."""
    flat = with_text(raw).withColumn("complaint_cleaned", X.clean_text(F.col(TEXT)))
    tagged = lemmatize_and_tag(flat, lexicon, **bounds)
    return tagged.withColumn(
        "complaint_final", X.mask_cleanup(F.col("complaint_pos_filtered"))
    )
