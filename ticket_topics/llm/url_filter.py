"""URL filter: host and path rules, then a ratio of character language models.

Two smoothed variable-order Markov models are counted over the characters of the
URLs that the rules accept and reject. Every gram that either class holds at least
``min_count`` times is kept, so the models grow with the input and a rare class keeps
its own; a character is predicted from the longest context kept. A URL's score is the mean log
ratio of both models per character, and the cut between accept and reject is set on
rule-judged URLs that took no part in the counts.

Everything is DataFrame functions. The sum over a URL needs one join, as the
table holds for each gram what it changes against the gram one character shorter:
the changes of all grams that end at a character add up to the longest one's ratio.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, BROADCAST_ROWS
from ..operators.joins import lookup_join
from ..session import staged
from .common import text_of

A_TO_Z = "abcdefghijklmnopqrstuvwxyz"
HELD_OUT = 5  # one in so many distinct rule-judged URLs sets the cut
BINS, BIN_WIDTH = 1000, 0.01  # the cut is sought on this grid either side of zero


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path:
    from there up to ``? #`` or the end. Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, A_TO_Z.upper(), A_TO_Z), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    chosen = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def letters(url: Column) -> Column:
    """What the models read: the URL after ``://`` (all of it where there is none) in
    lower case, in 42 letters: others become ``~``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url)
    return F.regexp_replace(F.lower(rest), r"(?s)[^a-z0-9./\-_?]", "~")


def grams(letters_col: Column, order: int) -> Column:
    """All grams of 1 to ``order + 1`` letters, one element each; the start is padded."""
    padded = F.concat(F.lit("^" * order), letters_col)
    ends = F.when(F.length(letters_col) > 0, F.sequence(F.lit(1), F.length(letters_col)))
    return F.flatten(
        F.transform(
            ends,
            lambda i: F.transform(
                F.sequence(F.lit(0), F.lit(order)),
                lambda k: F.substring(padded, i + order - k, k + 1),
            ),
        )
    )


def train(urls: DataFrame, order: int, min_count: int) -> DataFrame:
    """``gram, delta`` from ``letters, allow``, both models in one table.

    Grams are counted per task before the shuffle. Witten-Bell smoothing: with n
    characters seen after a context and t different ones, the longer context has the
    weight n / (n + t). An empty class leaves its model uniform.
    """
    seen = urls.select("allow", F.explode(grams(F.col("letters"), order)).alias("gram"))
    counts = staged(
        seen.groupBy("gram").agg(
            F.sum(F.col("allow").cast("long")).alias("n1"),
            F.sum((~F.col("allow")).cast("long")).alias("n0"),
        ),
        "url-grams",
    ).withColumn("size", F.length("gram"))
    contexts = counts.groupBy(F.expr("substring(gram, 1, size - 1)").alias("context"), "size").agg(
        *[F.sum(n).alias(f"all_{n}") for n in ("n0", "n1")],
        *[F.sum((F.col(n) > 0).cast("long")).alias(f"kinds_{n}") for n in ("n0", "n1")],
    )
    kept = counts.where(F.greatest("n0", "n1") >= min_count).withColumn(
        "context", F.expr("substring(gram, 1, size - 1)")
    )
    table = staged(kept.join(contexts, ["context", "size"]), "url-kept-grams")

    alphabet = 43.0
    level = None
    done = None
    for size in range(1, order + 2):
        grams_here = table.where(F.col("size") == size)
        if level is None:
            grams_here = grams_here.withColumns({"q0": F.lit(1 / alphabet), "q1": F.lit(1 / alphabet)})
        else:
            # a kept gram's shorter gram is kept as well: in each class it is at least as frequent
            shorter = level.select(F.col("gram").alias("tail"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
            grams_here = grams_here.withColumn("tail", F.expr("substring(gram, 2)")).join(shorter, "tail")
        p = {
            f"p{c}": (F.col(f"n{c}") + F.col(f"kinds_n{c}") * F.col(f"q{c}"))
            / (F.col(f"all_n{c}") + F.col(f"kinds_n{c}"))
            for c in (0, 1)
        }
        empty = {f"p{c}": F.col(f"all_n{c}") == 0 for c in (0, 1)}
        level = grams_here.withColumns(
            {k: F.when(empty[k], F.col(k.replace("p", "q"))).otherwise(v) for k, v in p.items()}
        ).select("gram", "q0", "q1", "p0", "p1")
        done = level if done is None else done.unionByName(level)
    change = F.log(F.col("p1") / F.col("q1")) - F.log(F.col("p0") / F.col("q0"))
    return staged(done.select("gram", change.alias("delta")), "url-model")


def score(urls: DataFrame, model: DataFrame, order: int, **bounds) -> DataFrame:
    """``url_row, score``: mean log ratio per letter, positive when acceptable.

    ``model`` grows with the URLs learnt: it is broadcast while it is measured to be
    small, and joined without hot keys beyond that.
    """
    long = urls.select(
        "url_row",
        F.length("letters").alias("n"),
        F.explode(grams(F.col("letters"), order)).alias("gram"),
    )
    return (
        lookup_join(long, model, "gram", how="inner", **bounds)
        .groupBy("url_row")
        .agg((F.sum("delta") / F.first("n")).alias("score"))
    )


def cut_of(scored: DataFrame) -> float:
    """The score from which most held-out URLs are judged as the rules judge them,
    both classes weighing the same; the middle of the best stretch. 0 where a class
    is missing."""
    place = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN_WIDTH)))
    bins = scored.groupBy(place.alias("bin")).agg(
        F.sum(F.col("allow").cast("long")).alias("n1"),
        F.sum((~F.col("allow")).cast("long")).alias("n0"),
    )
    # at most 2001 rows from here on
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    share = lambda n: F.try_divide(F.sum(n).over(below), F.sum(n).over(every))
    right = share("n0") - share("n1")
    rated = bins.select("bin", right.alias("right"))
    best = rated.agg(
        F.max("right").alias("right"), F.max_by("bin", F.struct("right", -F.col("bin"))).alias("bin")
    )
    row = best.first()
    return 0.0 if row is None or row["right"] is None else (row["bin"] + 1) * BIN_WIDTH


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = 4,
    min_count: int = 1,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id, url, host, path, rule, score, verdict``, one row per input row.

    The verdict is the rule's, else ``allow`` from the calibrated cut on. Models learn
    from every rule-judged URL but one in five, by a hash of the URL, and keep all grams
    that a class holds ``min_count`` times; up to ``max_rows`` grams and ``max_bytes``
    they are broadcast. A null or empty URL scores 0; without rule-judged URLs of both
    kinds the cut is 0. Null and repeated ids stay as they are; an empty table gives no
    rows; other columns play no part.
    """
    url = text_of(url_col)
    host, path = host_and_path(url)
    rows = staged(
        pages.select(
            F.monotonically_increasing_id().alias("url_row"),
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{url_col}`").alias("url"),
            host.alias("host"),
            path.alias("path"),
            letters(url).alias("letters"),
        ).withColumns(
            {
                "rule": matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.name).cast("string"),
                "allow": matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.allow).cast("boolean"),
            }
        ),
        "urls",
    )
    ruled = rows.where(F.col("allow").isNotNull())
    held_out = F.pmod(F.crc32(F.col("letters").cast("binary")), F.lit(HELD_OUT)) == 0
    model = train(ruled.where(~held_out), order, min_count)
    scores = staged(score(rows, model, order, max_rows=max_rows, max_bytes=max_bytes), "url-scores")
    scored = rows.join(scores, "url_row", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )
    cut = cut_of(scored.where(F.col("allow").isNotNull() & held_out))
    verdict = F.when(F.coalesce("allow", F.col("score") >= cut), "allow").otherwise("block")
    return scored.select(
        "id", "url", "host", "path", "rule", "score", verdict.alias("verdict")
    )
