"""Train/test splits and bootstrap weights that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    BOOTSTRAP_FRACTION,
    BOOTSTRAP_REPLICATES,
    BOOTSTRAP_SEED,
    SPLIT_SEED,
)
from ..functions.arrays import bind
from ..functions.hashing import md5_bucket, md5_draw, poisson_weight


def hash_split(
    df: DataFrame,
    key: str = "id",
    train_percent: int = 80,
    seed: int = SPLIT_SEED,
    name: str = "split",
) -> DataFrame:
    """Add ``train`` or ``test`` from a hash of the key."""
    train = md5_bucket(seed, 100, F.col(key)) < train_percent
    return df.withColumn(name, F.when(train, "train").otherwise("test"))


def random_split(df: DataFrame, train_percent: int = 80, seed: int = SPLIT_SEED):
    """Spark's own split; its rows depend on how ``df`` is partitioned."""
    share = train_percent / 100.0
    return df.randomSplit([share, 1.0 - share], seed=seed)


def bootstrap_weights(
    df: DataFrame,
    key: str = "id",
    replicates: int = BOOTSTRAP_REPLICATES,
    fraction: float = BOOTSTRAP_FRACTION,
    seed: int = BOOTSTRAP_SEED,
) -> DataFrame:
    """Add ``rep, weight``: how often a row is drawn, with replacement, into each
    replicate. Rows not drawn are left out, so about ``fraction`` of the rows
    leave the map side per replicate."""
    def draw(rep):
        return bind(
            md5_draw(seed, rep, F.col(key)),
            lambda d: F.struct(
                rep.alias("rep"), poisson_weight(d, fraction).alias("weight")
            ),
        )

    draws = F.transform(F.sequence(F.lit(1), F.lit(replicates)), draw)
    drawn = F.filter(draws, lambda d: d["weight"] > 0)
    return df.select("*", F.inline(drawn))
