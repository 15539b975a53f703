"""Part-of-speech tags in context: a bigram hidden Markov model.

Spark counts how tags follow each other and which tags a form bears, in tagged sentences
that are one row each; nothing but the counts is shuffled. A form that was not seen is
judged by its suffixes, as seen on rare forms, each suffix smoothed by the next shorter
one. A text is tagged by the most likely sequence of tags (Viterbi), for all texts of an
Arrow batch at once.

The lexicon of :mod:`lexicon` stays the cheap way, which gives a form one tag wherever it
stands.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..config import BROADCAST_BYTES, BROADCAST_ROWS
from ..functions import text as X
from ..functions.arrays import bind
from ..session import staged
from .joins import is_small, lookup_join
from .lexicon import NOUN, joined_texts
from .word_blocks import asked_words, found_places, split_words, with_found, word_blocks

SUFFIX = 4  # longest suffix looked at
RARE = 10  # forms seen so often at most say what unknown forms are like
MOST_TAGS = 500  # transitions are a matrix on every node
LEAST_PRIOR = 1e-3  # weight of a tag's own share in a transition, at least
NEVER = -1e30  # log probability of a tag a known form does not bear
CELLS = 1 << 21  # scores of tokens worked on at a time (or one text's)


@dataclass(frozen=True)
class Tagger:
    """``transitions[i, j]``: log probability of tag j behind tag i; the last row begins a
    text. ``forms``: ``form, scores, lemmas`` and ``suffixes``: ``suffix, scores`` hold a
    value for each tag."""

    tags: tuple[str, ...]
    transitions: np.ndarray
    forms: DataFrame
    suffixes: DataFrame


def tag_bigrams(sentences: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``previous, tag, n``; previous is null at the beginning of a sentence."""
    def paired(t):
        return F.transform(
            t,
            lambda token, i: F.struct(
                F.when(i > 0, F.get(t, i - 1)["tag"]).alias("previous"), token["tag"].alias("tag")
            ),
        )

    pairs = bind(F.col(tokens), paired)
    rows = sentences.select(F.explode(pairs).alias("pair")).select("pair.*")
    return rows.groupBy("previous", "tag").agg(F.count(F.lit(1)).alias("n"))


def tag_forms(sentences: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``form, tag, lemma, n``: how often a form bears a tag, and its most frequent lemma
    under it, ties to the lower one."""
    rows = sentences.select(F.explode(tokens).alias("token")).select("token.*")
    counts = rows.groupBy("form", "tag", "lemma").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "lemma"))
    return counts.groupBy("form", "tag").agg(
        best["lemma"].alias("lemma"), F.sum("n").alias("n")
    )


def transitions_of(pairs: dict[tuple[str | None, str], int], tags: tuple[str, ...]) -> np.ndarray:
    """Bigrams mixed with the shares of single tags.

    Every bigram votes, with its count, for the one of both estimates that foresees it
    better when one occurrence is taken away; the votes are the weights.
    """
    place = {t: i for i, t in enumerate(tags)}
    counts = np.zeros((len(tags) + 1, len(tags)))
    for (previous, tag), n in pairs.items():
        counts[place[previous] if previous is not None else len(tags), place[tag]] += n
    single, total = counts.sum(axis=0), counts.sum()
    before = counts.sum(axis=1, keepdims=True)
    by_pair = np.where(before > 1, (counts - 1) / np.maximum(before - 1, 1), 0)
    by_tag = (single - 1) / max(total - 1, 1)
    paired = counts[(counts > 0) & (by_pair > by_tag)].sum() / total
    weight = min(paired, 1 - LEAST_PRIOR)
    mixed = weight * counts / np.maximum(before, 1) + (1 - weight) * single / total
    # a tag that never precedes another is followed by any, by its share
    mixed = np.where(before > 0, mixed, single / total)
    return np.log(mixed)


def fit_tagger(
    sentences: DataFrame, tokens: str = "tokens", suffix: int = SUFFIX, rare: int = RARE
) -> Tagger:
    """Model of ``tokens``, an array of ``form, tag, lemma`` in each row.

    Tokens without a form or tag are left out; a missing lemma is the form.
    """
    known = F.filter(tokens, lambda t: t["form"].isNotNull() & t["tag"].isNotNull())
    named = F.transform(
        known,
        lambda t: F.struct(
            t["form"].alias("form"), t["tag"].alias("tag"), F.coalesce(t["lemma"], t["form"]).alias("lemma")
        ),
    )
    rows = sentences.select(named.alias("tokens"))
    pairs = {(r.previous, r.tag): r.n for r in tag_bigrams(rows).limit(MOST_TAGS**2 + 1).collect()}
    tags = tuple(sorted({tag for _, tag in pairs}))
    if not 0 < len(tags) <= MOST_TAGS:
        raise ValueError(f"sentences need 1 to {MOST_TAGS} tags")
    total = {t: sum(n for (_, tag), n in pairs.items() if tag == t) for t in tags}
    counts = staged(tag_forms(rows), "tag-forms")
    entries = counts.groupBy("form").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", F.struct("n", "lemma")))).alias("by_tag"),
        F.sum("n").alias("n"),
    )
    found = [F.col("by_tag")[t] for t in tags]
    scores = [
        F.coalesce(F.log(f["n"] / F.lit(total[t])), F.lit(NEVER)) for f, t in zip(found, tags, strict=True)
    ]
    forms = staged(
        entries.select(
            "form",
            F.array(*scores).alias("scores"),
            F.array(*[f["lemma"] for f in found]).alias("lemmas"),
            "n",
        ),
        "tagger-forms",
    )
    suffixes = staged(_suffix_scores(counts, forms, tags, total, suffix, rare), "tagger-suffixes")
    return Tagger(tags, transitions_of(pairs, tags), forms.drop("n"), suffixes)


def _suffix_scores(counts, forms, tags, total, longest, rare) -> DataFrame:
    """``suffix, scores``: log share of each tag behind a suffix over its share anywhere.

    The empty suffix has no evidence: all scores 0. A longer one mixes its own counts on
    rare forms with the shares of the next shorter one.
    """
    share = np.array([total[t] for t in tags]) / sum(total.values())
    theta = float(np.std(share, ddof=1)) if len(tags) > 1 else 1.0
    few = forms.where(F.col("n") <= rare).select("form")
    seen = counts.join(few, "form", "left_semi")
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("form")))
    ends = seen.select(
        "tag", "n", F.explode(F.transform(lengths, lambda k: F.right("form", k))).alias("suffix")
    )
    sums = ends.groupBy("suffix", "tag").agg(F.sum("n").alias("n"))
    by_tag = sums.groupBy("suffix").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("by_tag"), F.sum("n").alias("all")
    )
    own = F.array(
        *[F.coalesce(F.col("by_tag")[t], F.lit(0)) / F.col("all") for t in tags]
    )
    rows = staged(by_tag.select("suffix", own.alias("own")), "suffix-shares")
    level = counts.sparkSession.createDataFrame(
        [("", [float(s) for s in share])], "suffix string, shares array<double>"
    )
    levels = [level]
    for k in range(1, longest + 1):
        shorter = level.select(F.col("suffix").alias("shorter"), F.col("shares").alias("back"))
        here = rows.where(F.length("suffix") == k).withColumn("shorter", F.expr("substring(suffix, 2)"))
        level = here.join(shorter, "shorter").select(
            "suffix",
            F.transform(
                F.arrays_zip("own", "back"), lambda z: (z["own"] + theta * z["back"]) / (1 + theta)
            ).alias("shares"),
        )
        levels.append(level)
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    priors = F.array(*[F.lit(float(s)) for s in share])
    return every.select(
        "suffix",
        F.transform(
            F.arrays_zip("shares", priors.alias("prior")), lambda z: F.log(z["shares"]) - F.log(z["prior"])
        ).alias("scores"),
    )


def viterbi(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The most likely tags of texts whose tokens' ``scores`` lie one after the other.

    All texts take a step together, the longest first; the lower tag wins a tie.
    """
    kinds = scores.shape[1]
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = begin[order], lengths[order]
    back = np.zeros(scores.shape, dtype=np.int16)
    out = np.zeros(len(scores), dtype=np.int64)
    active = int((sizes > 0).sum())
    best = transitions[-1] + scores[begin[:active]]
    last = np.zeros(active, dtype=np.int64)
    steps = int(sizes[0]) if len(sizes) else 0
    for t in range(1, steps):
        on = int(np.searchsorted(-sizes, -t, side="left"))
        last[on:active] = best[on:active].argmax(axis=1)
        active, best = on, best[:on]
        ways = best[:, :, None] + transitions[None, :kinds]
        came = ways.argmax(axis=1)
        back[begin[:on] + t] = came
        best = np.take_along_axis(ways, came[:, None], axis=1)[:, 0] + scores[begin[:on] + t]
    last[:active] = best.argmax(axis=1)
    now = last
    for t in range(steps - 1, -1, -1):
        on = int(np.searchsorted(-sizes, -t, side="left"))
        at = begin[:on] + t
        out[at] = now[:on]
        now[:on] = back[at, now[:on]]
    return out


def _decode(
    scores_of: Callable[[int, int], np.ndarray], lengths: np.ndarray, transitions, tags
) -> np.ndarray:
    """Numbers of the tags of all texts, a slice of texts at a time; ``scores_of`` gives the
    scores of a range of tokens."""
    ends = np.cumsum(lengths)
    found, begin = [np.empty(0, dtype=np.int64)], 0
    while begin < len(lengths):
        before = int(ends[begin - 1]) if begin else 0
        end = int(np.searchsorted(ends, before + CELLS // len(tags), side="right"))
        end = max(end, begin + 1)
        scores = scores_of(before, int(ends[end - 1]))
        found.append(viterbi(scores, lengths[begin:end], transitions))
        begin = end
    return np.concatenate(found)


def _named(found: np.ndarray, lengths: np.ndarray, tags: tuple[str, ...]) -> pa.Array:
    names = pa.array(tags, pa.string()).take(pa.array(found))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), names)


def _with_lemmas(words: pa.DictionaryArray, found, lengths, lemma: pa.Array, tags) -> list[pa.Array]:
    """Lemma texts and noun texts; a word without a ``lemma`` under its tag is its own."""
    noun = pa.array(found == (tags.index(NOUN) if NOUN in tags else -1))
    return joined_texts(pc.coalesce(lemma, words.dictionary_decode()), noun, lengths)


def add_tags(
    df: DataFrame,
    tagger: Tagger,
    column: str = "complaint_cleaned",
    tags: str = "tags",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the tag of every word of ``column``, an array; null and empty texts have none.

    A model measured to be small is broadcast and the texts are tagged where they lie. A
    larger one is asked by blocks of rows (:mod:`word_blocks`). Both ways give the same
    rows; rows need no key.
    """
    forms, suffixes = tagger.forms.select("form", "scores"), tagger.suffixes
    if is_small(forms, max_rows, max_bytes) and is_small(suffixes, max_rows, max_bytes):
        return _by_broadcast(df, tagger, column, (tags,))
    return _by_join(df, tagger, column, tags, max_rows, max_bytes)


def _table(df: DataFrame, key: str) -> tuple[pd.Index, np.ndarray]:
    table = df.select(key, "scores").toArrow()
    scores = np.asarray(table.column("scores").combine_chunks().flatten(), dtype=np.float64)
    return pd.Index(table.column(key).to_pandas()), scores.reshape(table.num_rows, -1)


def _by_broadcast(df, tagger, column, outs):
    """``outs`` names the tags, or the lemma text and the noun text."""
    share = df.sparkSession.sparkContext.broadcast
    own = None
    if len(outs) == 2:
        forms = tagger.forms.select("form", "scores", "lemmas").toArrow()
        own = forms.column("lemmas").combine_chunks().flatten()
        scores = np.asarray(forms.column("scores").combine_chunks().flatten(), dtype=np.float64)
        table = pd.Index(forms.column("form").to_pandas()), scores.reshape(forms.num_rows, -1)
    else:
        table = _table(tagger.forms, "form")
    shared = share((table, _table(tagger.suffixes, "suffix"), own))
    longest = int(tagger.suffixes.agg(F.max(F.length("suffix"))).first()[0])
    names, transitions = tagger.tags, tagger.transitions

    def decoded(tokens: pa.Array):
        (form_index, form_scores), (suffix_index, suffix_scores), _ = shared.value
        coded = tokens.flatten().dictionary_encode()
        forms = coded.dictionary.to_pandas()
        at = form_index.get_indexer(forms)
        scores = np.zeros((len(forms), len(names)))
        scores[at >= 0] = form_scores[at[at >= 0]]
        open_rows = np.flatnonzero(at < 0)
        for k in range(longest, -1, -1):
            ends = [forms[i][len(forms[i]) - min(k, len(forms[i])):] for i in open_rows]
            found = suffix_index.get_indexer(pd.Index(ends, dtype=object))
            scores[open_rows[found >= 0]] = suffix_scores[found[found >= 0]]
            open_rows = open_rows[found < 0]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths = np.asarray(tokens.value_lengths(), dtype=np.int64)
        found = _decode(lambda a, b: scores[codes[a:b]], lengths, transitions, names)
        return coded, at[codes], found, lengths

    @F.arrow_udf("array<string>")
    def tagged(tokens: pa.Array) -> pa.Array:
        _, _, found, lengths = decoded(tokens)
        return _named(found, lengths, names)

    @F.arrow_udf("struct<lemmas: string, nouns: string>")
    def lemmatized(tokens: pa.Array) -> pa.Array:
        coded, at, found, lengths = decoded(tokens)
        lemma = shared.value[2].take(pa.array(at * len(names) + found, mask=at < 0))
        return pa.StructArray.from_arrays(
            _with_lemmas(coded, found, lengths, lemma, names), names=["lemmas", "nouns"]
        )

    words = X.words(F.coalesce(F.col(column), F.lit("")))
    if len(outs) == 1:
        return df.withColumn(outs[0], tagged(words))
    texts = df.withColumn("_found", lemmatized(words))
    for name, part in zip(outs, ("lemmas", "nouns"), strict=True):
        texts = texts.withColumn(name, F.col(f"_found.{part}"))
    return texts.drop("_found")


def form_scores(forms: DataFrame, tagger: Tagger, **bounds) -> DataFrame:
    """``form, scores`` of distinct ``form``: as seen, else by the longest known suffix."""
    longest = int(tagger.suffixes.agg(F.max(F.length("suffix"))).first()[0])
    seen = staged(forms.join(tagger.forms.select("form", "scores"), "form", "left"), "form-scores")
    lengths = F.sequence(F.lit(0), F.least(F.lit(longest), F.length("form")))
    ends = seen.where(F.col("scores").isNull()).select(
        "form", F.explode(F.transform(lengths, lambda k: F.right("form", k))).alias("suffix")
    )
    # the shortest suffixes are borne by all forms, so the lookup must not shuffle by them
    met = lookup_join(ends, tagger.suffixes, "suffix", "inner", **bounds)
    guessed = met.groupBy("form").agg(F.max_by("scores", F.length("suffix")).alias("scores"))
    return seen.where(F.col("scores").isNotNull()).unionByName(guessed)


def _by_join(df, tagger, column, tags, max_rows, max_bytes):
    kinds = {tags: ArrayType(StringType())}
    return _by_blocks(df, tagger, column, kinds, max_rows=max_rows, max_bytes=max_bytes)


def _by_blocks(df, tagger, column, kinds, **bounds):
    """Each distinct form of the texts is looked up once, and each block of rows is sent the
    scores of its own forms. ``kinds`` are the tags, or the lemma text and the noun text,
    with their types."""
    outs = tuple(kinds)
    blocks = word_blocks(df, X.words(F.coalesce(F.col(column), F.lit(""))))
    forms = asked_words(blocks, "form").select("form").distinct()
    scores = staged(form_scores(forms, tagger, **bounds), "token-scores")
    if len(outs) == 2:
        lemmas = tagger.forms.select("form", "lemmas").hint("merge")
        scores = scores.join(lemmas, "form", "left")
    else:
        scores = scores.withColumn("lemmas", F.lit(None).cast("array<string>"))
    # few tags are borne by a form, so it carries those alone
    every = F.transform(
        "scores",
        lambda s, i: F.struct(i.alias("tag"), s.alias("score"), F.get("lemmas", i).alias("lemma")),
    )
    borne = scores.select("form", F.filter(every, lambda t: t["score"] > NEVER).alias("borne"))
    names, transitions, kept = tagger.tags, tagger.transitions, [c for c in df.columns if c not in outs]

    def run(found: pa.Table, rows: pa.Table) -> pa.Table:
        words, lengths = split_words(rows.column("_words"))
        coded, at = found_places(found, "form", words)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        entries = found.column("borne").combine_chunks()
        sizes = np.asarray(pc.list_value_length(entries), dtype=np.int64)
        first = (np.cumsum(sizes) - sizes)[at]
        sizes, flat = sizes[at], entries.flatten()
        tag, score = (np.asarray(flat.field(k)) for k in ("tag", "score"))

        def scores_of(a: int, b: int) -> np.ndarray:
            out = np.full((b - a, len(names)), NEVER)
            here = codes[a:b]
            n = sizes[here]
            token = np.repeat(np.arange(b - a), n)
            entry = np.arange(len(token)) + np.repeat(first[here] - (np.cumsum(n) - n), n)
            out[token, tag[entry]] = score[entry]
            return out

        best = _decode(scores_of, lengths, transitions, names)
        if len(outs) == 1:
            more = [_named(best, lengths, names)]
        else:
            # the entries of a form lie in the order of their tags
            owner = np.repeat(np.arange(len(entries)), np.asarray(pc.list_value_length(entries)))
            keys, wanted = owner * len(names) + tag, at[codes] * len(names) + best
            place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            known = keys[place] == wanted if len(keys) else np.zeros(len(wanted), dtype=bool)
            lemma = flat.field("lemma").take(pa.array(place, mask=~known))
            more = _with_lemmas(coded, best, lengths, lemma, names)
        return pa.table([*[rows.column(c) for c in kept], *more], [*kept, *outs])

    # as stored: whatever files hold may be null, also inside an array
    fields = [blocks.schema[c] for c in kept] + [StructField(c, k) for c, k in kinds.items()]
    return with_found(blocks, borne, "form", run, StructType(fields))


def lemmatize_in_context(
    df: DataFrame,
    tagger: Tagger,
    column: str = "complaint_cleaned",
    lemmas: str = "complaint_lemmatized",
    nouns: str = "complaint_pos_filtered",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the lemma text and the noun-only text of ``column``, as tagged in context.

    A word's lemma is that of its form under its tag; an unknown form is its own. A text
    without nouns gives ``''``. Tagging and lemmas are one pass over the texts.
    """
    bounds = {"max_rows": max_rows, "max_bytes": max_bytes}
    if all(is_small(t, **bounds) for t in (_unnested(tagger.forms), tagger.suffixes)):
        return _by_broadcast(df, tagger, column, (lemmas, nouns))
    return _by_blocks(df, tagger, column, {lemmas: StringType(), nouns: StringType()}, **bounds)


def _unnested(forms: DataFrame) -> DataFrame:
    """The forms with the characters of their lemmas, for a measure of their size."""
    return forms.withColumn("_letters", F.array_join("lemmas", ""))
