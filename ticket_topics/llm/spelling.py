"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

Every letter is hashed to one of a few symbols, so a word becomes a reduced word of the
same length. Words one edit apart have reduced words that are equal or one edit apart.
The full one-edit neighbourhood of each distinct reduced word is generated and joined
with the reduced words that occur; only the words behind such pairs are compared, letter
by letter, and only words exactly one edit apart are near.

The words behind one reduced word are held in chunks, and chunks meet inside a row, so
candidate pairs never become rows and a reduced word that very many words share is
spread over many rows. No step runs Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind
from ..operators.joins import hot_keys, skew_join
from ..session import staged
from .common import text_of

WORD = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 4
LEAST_LENGTH, LEAST_COUNT = 5, 3
RATIO = 2  # a form occurs at least so many times as often as its variant
CHUNK = 256  # words of one reduced word in a row


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, word`` for every maximal run of letters, A-Z in lower case; a null text has none."""
    low = F.translate(text_of(text_col), CAPITALS, SMALL)
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.explode(F.regexp_extract_all(low, F.lit(WORD), F.lit(0))).alias("word"),
    )


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """Each letter replaced by the symbol that its code point hashes to."""
    letters = F.split(word, "")
    mapped = F.transform(
        letters,
        lambda c: F.chr(
            F.lit(97) + F.pmod(F.shiftright(F.ascii(c).cast("bigint") * 2654435761, 13), F.lit(symbols))
        ),
    )
    return F.array_join(mapped, "")


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """The reduced word and every one that one deleted, replaced or inserted symbol makes."""
    alphabet = F.array(*[F.lit(chr(97 + s)) for s in range(symbols)])
    size = F.length(word)

    def before(i: Column) -> Column:
        return F.substring(word, F.lit(1), i)

    def behind(i: Column) -> Column:
        return F.substring(word, i + 1, size)

    gaps, places = F.sequence(F.lit(0), size), F.sequence(F.lit(0), size - 1)
    deleted = F.transform(places, lambda i: F.concat(before(i), behind(i + 1)))
    replaced = F.transform(
        places, lambda i: F.transform(alphabet, lambda s: F.concat(before(i), s, behind(i + 1)))
    )
    inserted = F.transform(
        gaps, lambda i: F.transform(alphabet, lambda s: F.concat(before(i), s, behind(i)))
    )
    return F.array_distinct(
        F.concat(F.array(word), deleted, F.flatten(replaced), F.flatten(inserted))
    )


def vocabulary(
    words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough; null words have no part."""
    long_enough = words.where(F.length("word") >= least_length)
    counts = long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def _chunks(words: DataFrame, sizes: DataFrame) -> DataFrame:
    """``reduced, words``: the words of a reduced word in rows of about CHUNK."""
    sized = skew_join(words, sizes, "reduced", hot_keys(sizes, "reduced", "n_words"), "inner")
    parts = F.ceil(F.col("n_words") / CHUNK).cast("bigint")
    return (
        sized.withColumn("part", F.pmod(F.xxhash64("word"), parts))
        .groupBy("reduced", "part")
        .agg(F.collect_list(F.struct("word", "n")).alias("words"))
        .drop("part")
    )


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n_near, best`` for each word of ``word, n`` that has a near word.

    Words are distinct. ``best`` holds the negative count and the text of the most
    frequent near word, ties to the smallest in code-point order.
    """
    words = staged(words.select("word", "n", reduced(F.col("word"), symbols).alias("reduced")), "words")
    sizes = staged(
        words.groupBy("reduced").agg(F.count(F.lit(1)).alias("n_words")), "reduced-words"
    )
    chunks = staged(_chunks(words, sizes), "word-chunks")
    found = sizes.select("reduced", F.explode(neighbourhood(F.col("reduced"), symbols)).alias("near"))
    # files of words are small beside their rows, so no side is broadcast for its file
    known = sizes.select(F.col("reduced").alias("near")).hint("merge")
    pairs = found.join(known, "near", "left_semi")
    left = chunks.join(pairs.hint("merge"), "reduced").select("near", F.col("words").alias("mine"))
    right = chunks.select(F.col("reduced").alias("near"), F.col("words").alias("others"))

    def verified(mine: Column) -> Column:
        near = F.filter(
            F.col("others"), lambda o: F.levenshtein(mine["word"], o["word"], 1) == 1
        )
        return bind(
            near,
            lambda found: F.struct(
                mine["word"].alias("word"),
                F.size(found).cast("bigint").alias("n_near"),
                F.array_min(
                    F.transform(found, lambda o: F.struct((-o["n"]).alias("less"), o["word"].alias("word")))
                ).alias("best"),
            ),
        )

    met = left.join(right.hint("merge"), "near").select(
        F.explode(
            F.filter(F.transform("mine", verified), lambda row: row["n_near"] > 0)
        ).alias("row")
    )
    return (
        met.select("row.*")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """Stored ``word, root`` of ``word, form``: the last word that following forms reaches.

    Every round a word takes the root of its root, so a chain of length n takes about
    log2(n) rounds; counts double along a chain, so chains are short. The driver
    broadcasts nothing but the roots that are too frequent for a shuffle.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        counts = staged(now.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "root-counts")
        hot = hot_keys(counts, "root")
        moved = staged(skew_join(now, ahead, "root", hot, "left"), "next-forms")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = moved.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(
    words: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each frequent word of ``word``.

    ``words`` has one row per occurrence. A word's form is its most frequent near word
    if that occurs ``ratio`` (more than 1) times as often, else null; the root is reached
    by following forms. Null and short words take no part; other columns are left alone;
    an empty table gives no rows. Words of any length and alphabet are handled.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms could run in a circle")
    counted = staged(vocabulary(words.select("word"), least_length, least_count), "vocabulary")
    near = near_words(counted, symbols)
    least_n = F.col("best.less") * -1
    formed = staged(
        counted.join(near.hint("merge"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(least_n >= ratio * F.col("n"), F.col("best.word")).alias("form"),
            F.when(least_n >= ratio * F.col("n"), least_n).alias("form_n"),
        ),
        "word-forms",
    )
    ends = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
