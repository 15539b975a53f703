"""Joins against dictionaries whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, BROADCAST_ROWS
from ..session import staged

# A key is hot when its rows exceed the mean shuffle partition divided by this.
HOT_PARTS = 4
# Frequent keys that are answered from a broadcast, and steps of a doubling they are cut at.
FREQUENT_KEYS, FREQUENT_STEPS = 1 << 17, 8


def is_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a table: true when rows and bytes are both within the bounds."""
    width = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "string":
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind == "array":
            width = width + 16 * F.coalesce(F.size(field.name), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Keys with more rows than a quarter of the mean shuffle partition.

    ``counts`` is a stored table of one row per key. As the shares add up to one,
    at most ``HOT_PARTS`` keys per shuffle partition are hot, whatever the data.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) * F.lit(HOT_PARTS * parts) > F.lit(total)).select(key)


def frequent_keys(counts: DataFrame, key: str, n: str = "n", most: int = FREQUENT_KEYS) -> DataFrame:
    """The keys with the most rows, about ``most`` at the most, hot ones among them.

    The cut lies between two classes of counts, so only one number for each class
    reaches the driver. Of words, whose counts fall steeply, few rows are left over.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = F.floor(F.log2(F.col(n).cast("double")) * FREQUENT_STEPS)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)), F.sum(n)).collect()
    total, held, least = sum(r[2] for r in sizes), 0, None
    for at, keys, _ in sorted(sizes, reverse=True):
        held += keys
        if held > most:
            break
        least = at
    hot = F.col(n) * F.lit(HOT_PARTS * parts) > F.lit(total)
    return counts.where(hot if least is None else hot | (step >= F.lit(least))).select(key)


def skew_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "left"
) -> DataFrame:
    """Join ``left`` with one row of ``right`` per ``key`` without a hot shuffle key.

    ``hot`` holds the hot keys (:func:`hot_keys`). Rows of hot keys are answered
    from a broadcast and rows without a key from nothing; neither enters the
    shuffle, which sees the cold keys only. ``left`` is read three times: give a
    stored table. ``how`` is left or inner.
    """
    values = [c for c in right.columns if c != key]
    order = [*left.columns, *values]
    if hot.isEmpty() and how == "inner":
        return left.join(right.hint("merge"), key, how).select(*order)
    hot_right = right.join(F.broadcast(hot), key, "left_semi")
    cold = left.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti")
    parts = [
        left.join(F.broadcast(hot_right), key, "inner").select(*order),
        # a table that is small in its files alone is not broadcast
        cold.join(right.hint("merge"), key, how).select(*order),
    ]
    if how == "left":
        # a hot key that the dictionary lacks stays unanswered
        unknown = hot.join(hot_right.select(key), key, "left_anti")
        empty = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values]
        parts.append(
            left.join(F.broadcast(unknown), key, "left_semi").select(*left.columns, *empty)
        )
        parts.append(left.where(F.col(key).isNull()).select(*left.columns, *empty))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Join ``left`` with one dictionary row per ``key``; ``how`` is left or inner.

    A dictionary measured to be small is broadcast where the rows lie. Beyond the
    bound ``left`` is stored once, unless it is ``stored`` and cheap to read, its keys are counted, and :func:`skew_join`
    answers the frequent ones apart: as many as are measured to be small. Both ways
    give the same rows.
    """
    if is_small(lookup, max_rows, max_bytes):
        return left.join(F.broadcast(lookup), key, how).select(
            *left.columns, *[c for c in lookup.columns if c != key]
        )
    rows = left if stored else staged(left, "lookup-rows")
    counts = staged(
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")),
        "key-counts",
    )
    frequent = staged(frequent_keys(counts, key), "frequent-keys")
    held = lookup.join(F.broadcast(frequent), key, "left_semi")
    if not is_small(frequent) or not is_small(held):
        frequent = hot_keys(counts, key)
    return skew_join(rows, lookup, key, frequent, how)
