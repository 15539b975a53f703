"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, skew_join
from ..session import staged


def components(links: DataFrame) -> DataFrame:
    """Stored ``node, label`` for every node of ``a, b``: the smallest node it reaches.

    Every round a node takes the smallest label among its neighbours and then the label
    of that label, so the rounds grow with the logarithm of a chain's length. Labels and
    links stay tables; a node with very many links is answered from a broadcast.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    both = staged(both.where("node <> near").distinct(), "links")
    counts = staged(both.groupBy("near").agg(F.count(F.lit(1)).alias("n")), "link-counts")
    hot = staged(hot_keys(counts, "near"), "hot-nodes")
    labels = staged(
        both.groupBy("node").agg(F.min("near").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        near = labels.select(F.col("node").alias("near"), F.col("label").alias("near_label"))
        best = (
            skew_join(both, near, "near", hot, "inner")
            .groupBy("node")
            .agg(F.min("near_label").alias("best"))
        )
        lower = staged(
            labels.join(best, "node").select(
                "node", "label", F.least("label", "best").alias("next")
            ),
            "lower-labels",
        )
        # follow each label once: a component's label may be asked for by all its nodes
        asked = staged(lower.groupBy("next").agg(F.count(F.lit(1)).alias("n")), "asked")
        jump = asked.join(
            lower.select(F.col("node").alias("next"), F.col("next").alias("jump")), "next"
        ).select("next", "jump")
        moved = staged(
            skew_join(lower, jump, "next", hot_keys(asked, "next"), "left").select(
                "node", "label", F.least("next", F.coalesce("jump", "next")).alias("new")
            ),
            "moved-labels",
        )
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("new < label").isEmpty():
            return labels
