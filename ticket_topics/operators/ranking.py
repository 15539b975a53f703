"""Numbering rows without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def number_rows(df: DataFrame, *order: Column, name: str = "row_id") -> DataFrame:
    """1-based position of every row in the total order ``order``.

    The input is stored first, as finding the ranges reads it once more. Rows are
    range-partitioned and sorted once; each partition numbers its own rows while it
    is written, and the partition offsets (one row per partition) are joined back.
    The order columns must identify a row.
    """
    ordered = (
        staged(df, "unranked")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = staged(ordered, "ranked")
    table = table.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_idx", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = table.groupBy("_part").count()
    offsets = sizes.select(
        "_part",
        (
            F.sum("count").over(Window.orderBy("_part")) - F.col("count")
        ).alias("_before"),
    )
    return table.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_idx") + 1).alias(name), *df.columns
    )


def top_per_group(df: DataFrame, group: str, *order: Column, n: int, name: str = "rank"):
    """First ``n`` rows of each group; every task keeps at most ``n`` per group
    before the shuffle, so a hot group costs no more than a cold one."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
