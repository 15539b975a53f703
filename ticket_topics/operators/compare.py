"""Bootstrap metrics of a run and the test against the run before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    ALPHA,
    BOOTSTRAP_FRACTION,
    BOOTSTRAP_REPLICATES,
    BOOTSTRAP_SEED,
    METRICS,
)
from ..functions.stats import two_sided_p
from .evaluate import confusion, weighted_metrics
from .splits import bootstrap_weights


def bootstrap_metrics(
    scored: DataFrame,
    key: str = "id",
    label: str = "label",
    prediction: str = "prediction",
    by=(),
    replicates: int = BOOTSTRAP_REPLICATES,
    fraction: float = BOOTSTRAP_FRACTION,
    seed: int = BOOTSTRAP_SEED,
) -> DataFrame:
    """``by, rep, metric, value`` from one pass over rows scored once.

    The weights are summed per (replicate, label, prediction) before the
    shuffle. A replicate that drew no row has no metrics.
    """
    drawn = bootstrap_weights(scored, key, replicates, fraction, seed)
    groups = (*by, "rep")
    wide = weighted_metrics(
        confusion(drawn, label, prediction, groups, weight="weight"), groups
    )
    return wide.unpivot(list(groups), list(METRICS), "metric", "value")


def bootstrap_summary(metrics: DataFrame, by=()) -> DataFrame:
    """Mean, population deviation and linear 2.5/97.5 percentiles per metric."""
    return metrics.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.percentile("value", F.lit(0.025)).alias("p025"),
        F.percentile("value", F.lit(0.975)).alias("p975"),
    )


def complete_runs(runs: DataFrame, n_metrics: int = len(METRICS)) -> DataFrame:
    """Rows of runs that logged every metric."""
    w = Window.partitionBy("experiment", "run_id")
    return (
        runs.withColumn("_n", F.count(F.when(F.col("metric").isin(*METRICS), F.col("mean"))).over(w))
        .where(F.col("_n") >= n_metrics)
        .drop("_n")
    )


def previous_run(runs: DataFrame) -> DataFrame:
    """Add mean and deviation of the run before, per experiment and metric."""
    w = Window.partitionBy("experiment", "metric").orderBy("start_time", "run_id")
    complete = complete_runs(runs)
    return complete.withColumn("prev_mean", F.lag("mean").over(w)).withColumn(
        "prev_std", F.lag("std").over(w)
    )


def z_test(runs: DataFrame) -> DataFrame:
    """Add z score and two-sided p value; null without a previous run or spread."""
    spread = F.sqrt(F.col("std") ** 2 + F.col("prev_std") ** 2)
    z = F.try_divide(F.col("mean") - F.col("prev_mean"), spread)
    rows = runs.withColumn("z_score", z)
    return rows.withColumn("p_value", two_sided_p(F.col("z_score")))


def verdict(tested: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add the verdict; a first run has none."""
    p = F.col("p_value")
    return tested.withColumn(
        "verdict",
        F.when(p < alpha, "significant").when(p.isNotNull(), "not significant"),
    )


def compare_runs(runs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    return verdict(z_test(previous_run(runs)), alpha)


def verdict_text(tested: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add the sentence that reports a verdict."""
    change = F.when(F.col("p_value") < alpha, "changed").otherwise("did not change")
    return tested.withColumn(
        "report",
        F.when(
            F.col("p_value").isNotNull(),
            F.concat(
                "metric",
                F.lit(" "),
                change,
                F.lit(" since the run before: p = "),
                F.format_number("p_value", 4),
                F.lit(f" at level {alpha}"),
            ),
        ),
    )
