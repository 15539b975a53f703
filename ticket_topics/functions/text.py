"""Text rules as native column expressions.

``\\w``, ``\\d`` and ``\\s`` are meant in their Unicode sense; Java reads them as
ASCII, so the classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bind

WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\x1c-\x1f\x85\p{Z}"

PUNCTUATION = rf"[^{WORD_CHARS}{SPACE_CHARS}]"
# Whole words holding a digit. Anchored at the word start and possessive, so a
# long run of letters without a digit costs one scan instead of a quadratic one.
NUMERIC_WORD = (
    rf"(?<![{WORD_CHARS}])[\p{{L}}\p{{Nl}}\p{{No}}_]*+\p{{Nd}}[{WORD_CHARS}]*+"
)
DIGIT = r"\p{Nd}"
WORD_TOKEN = rf"([{WORD_CHARS}]{{2,}})"
SPACE_RUN = rf"[{SPACE_CHARS}]+"

ASCII_SPACES = " \t\n\x0b\f\r"

PRONOUN_MARK = "-PRON-"
REDACTION_MARK = "xxxx"


def strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, PUNCTUATION, "")


def strip_numeric_words(c: Column) -> Column:
    """Drop words with a digit; a text without digits is left after one search."""
    return bind(
        c,
        lambda t: F.when(
            F.regexp_like(t, F.lit(DIGIT)), F.regexp_replace(t, NUMERIC_WORD, "")
        ).otherwise(t),
    )


def clean_text(c: Column) -> Column:
    """Lower-case, drop punctuation, drop words with a digit; keep the spaces."""
    return strip_numeric_words(strip_punct(F.lower(c)))


def mask_cleanup(c: Column) -> Column:
    """Drop pronoun marks and each full four-letter redaction mark."""
    return F.replace(
        F.replace(c, F.lit(PRONOUN_MARK), F.lit("")), F.lit(REDACTION_MARK), F.lit("")
    )


def snake_case(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def words(c: Column) -> Column:
    """Non-empty tokens between runs of white space, in order."""
    return F.filter(F.split(c, SPACE_RUN), lambda w: w != "")


def tokenize_ws(c: Column, drop_empty: bool = False) -> Column:
    """Lower-case and split at every single white-space character.

    Same result as the ML ``Tokenizer``: empty tokens inside the text stay,
    those at its end go. ``drop_empty`` removes all of them.
    """
    none = F.array().cast("array<string>")
    blank = F.array(F.lit(""))

    def split(low: Column) -> Column:
        parts = F.split(F.rtrim(low, F.lit(ASCII_SPACES)), r"\s")
        return bind(parts, lambda p: F.when((p == blank) & (low != ""), none).otherwise(p))

    tokens = bind(F.lower(c), split)
    return F.filter(tokens, lambda w: w != "") if drop_empty else tokens


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_TOKEN), F.lit(1))


def remove_stopwords(tokens: Column, stop_words, case_sensitive: bool = False) -> Column:
    if case_sensitive:
        return F.filter(tokens, lambda w: ~w.isin(list(stop_words)))
    low = sorted({w.lower() for w in stop_words})
    return F.filter(tokens, lambda w: ~F.lower(w).isin(low))
