"""Topics that keep their ids and names when a model is fitted again.

Two fits number their topics in any order. Their term weights are compared by cosine, and
the assignment of new topics to old ones with the greatest sum of cosines (Hungarian
method) says which new topic goes on with which id. The term weights are tables joined by
term; only one cosine for each pair of topics reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_COSINE = 0.1  # topics less alike than this do not go on with each other
MAPPING = "fitted int, topic int, cosine double, state string"


def topic_cosines(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old, new, cosine`` of two long tables ``topic, term, weight``, for the pairs of
    topics that share a term. A topic without any weight is like none."""

    def lengths(weights: DataFrame, name: str) -> DataFrame:
        return weights.groupBy(F.col("topic").alias(name)).agg(
            F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias(f"{name}_length")
        )

    a = old.select("term", F.col("topic").alias("old"), F.col("weight").alias("a"))
    b = new.select("term", F.col("topic").alias("new"), F.col("weight").alias("b"))
    dots = a.join(b, "term").groupBy("old", "new").agg(F.sum(F.col("a") * F.col("b")).alias("dot"))
    # one row for each topic
    joined = dots.join(F.broadcast(lengths(old, "old")), "old").join(
        F.broadcast(lengths(new, "new")), "new"
    )
    product = F.col("old_length") * F.col("new_length")
    return joined.where(product > 0).select("old", "new", (F.col("dot") / product).alias("cosine"))


def assignment(gain: np.ndarray) -> list[int]:
    """Column of each row of a square matrix so that the sum of what they gain is greatest.

    Rows are added one at a time. Each takes the cheapest alternating path to a free
    column, where costs are measured against prices of rows and columns that keep all
    earlier choices optimal.
    """
    cost = gain.max(initial=0.0) - np.asarray(gain, dtype=np.float64)
    n = len(cost)
    row_price, column_price = np.zeros(n), np.zeros(n)
    row_of = np.full(n, -1)
    for row in range(n):
        slack, came = np.full(n, np.inf), np.full(n, -1)
        done = np.zeros(n, dtype=bool)
        at, column = row, -1
        while True:
            reduced = cost[at] - row_price[at] - column_price
            better = ~done & (reduced < slack)
            slack[better], came[better] = reduced[better], column
            nearest = int(np.where(done, np.inf, slack).argmin())
            step = slack[nearest]
            row_price[row] += step
            row_price[row_of[done]] += step
            column_price[done] -= step
            slack[~done] -= step
            done[nearest], column = True, nearest
            if row_of[nearest] < 0:
                break
            at = row_of[nearest]
        while column >= 0:
            before = came[column]
            row_of[column] = row_of[before] if before >= 0 else row
            column = before
    return np.argsort(row_of).tolist()


def align_topics(
    old: DataFrame, new: DataFrame, least: float = LEAST_COSINE
) -> list[tuple[int | None, int, float | None, str]]:
    """Rows ``fitted, topic, cosine, state``: the id each fitted topic goes on with.

    ``kept``: the fitted topic is the old one of this id. ``new``: no old topic is at least
    ``least`` alike, and the topic gets an id of its own behind all old ones. ``retired``:
    an old topic that no fitted one goes on with. ``old`` and ``new`` are long tables
    ``topic, term, weight``.
    """
    before, after = ([r[0] for r in t.select("topic").distinct().orderBy("topic").collect()] for t in (old, new))
    size = max(len(before), len(after))
    gain = np.zeros((size, size))
    for r in topic_cosines(old, new).collect():
        gain[after.index(r["new"]), before.index(r["old"])] = r["cosine"]
    columns = assignment(np.where(gain >= least, gain, 0.0))
    rows: list[tuple[int | None, int, float | None, str]] = []
    following = max(before, default=-1) + 1
    for i, fitted in enumerate(after):
        j = columns[i]
        if j < len(before) and gain[i, j] >= least:
            rows.append((fitted, before[j], float(gain[i, j]), "kept"))
        else:
            rows.append((fitted, following, None, "new"))
            following += 1
    kept = {topic for _, topic, _, state in rows if state == "kept"}
    rows += [(None, topic, None, "retired") for topic in before if topic not in kept]
    return rows


def mapping_table(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, MAPPING)


def same_ids(topics) -> list[tuple[int | None, int, float | None, str]]:
    """The mapping of a first fit: every topic is new and keeps its number."""
    return [(int(t), int(t), None, "new") for t in topics]


def kept_topic(fitted: Column, rows) -> Column:
    """The lasting id of a fitted topic; null where the mapping does not hold it."""
    pairs = [F.lit(v) for f, t, _, _ in rows if f is not None for v in (int(f), int(t))]
    return F.create_map(*pairs)[fitted.cast("int")]


def kept_mixture(mixture: Column, rows) -> Column:
    """A mixture by fitted topic as one by lasting id; ids without a topic have 0."""
    place = {t: f for f, t, _, _ in rows if f is not None}
    return F.array(
        *[F.get(mixture, place[t]) if t in place else F.lit(0.0) for t in range(max(place) + 1)]
    )
