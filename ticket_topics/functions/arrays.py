"""Array expressions that work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def term_frequencies(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of the distinct tokens of one row.

    Sorts the array and measures its runs, so a row is counted where it lies,
    without a shuffle. Null for an empty array.
    """

    def runs(s: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(1), F.size(s)),
            lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)),
        )
        return bind(
            first,
            lambda st: F.transform(
                st,
                lambda start, j: F.struct(
                    F.get(s, start - 1).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(s) + 1) - start).alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, runs(s)))


def argmax(values: Column) -> Column:
    """Index of the largest element; the lowest index wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
