import math
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ticket_topics.functions.hashing import md5_bucket, poisson_cuts
from ticket_topics.functions.stats import two_sided_p
from ticket_topics.operators import compare as C
from ticket_topics.operators import evaluate as E
from ticket_topics.operators import splits as S


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(i, y := rng.choice([0, 0, 0, 1, 2]), y if rng.random() < 0.7 else rng.choice([0, 1, 4])) for i in range(2000)]
    return spark.createDataFrame(rows, "id int, label int, prediction int").repartition(4).cache()


def test_metrics_equal_sparks_evaluator(scored):
    ours = E.weighted_metrics(E.confusion(scored)).first()
    doubles = scored.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for ours_name, theirs in names.items():
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(doubles)
        assert ours[ours_name] == pytest.approx(want, abs=1e-12)
    assert E.accuracy(scored).first().accuracy == pytest.approx(ours.accuracy)


def test_zero_rules(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (0, 3)], "label int, prediction int")
    report = {r["class"]: r for r in E.classification_report(E.confusion(rows)).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1) == (0.0, 0.0, 0.0)
    assert (report["3"].recall, report["3"].support) == (0.0, 0)
    assert report["0"].precision == 0.5 and report["0"].recall == 0.5
    assert report["macro avg"].recall == pytest.approx(0.5 / 3)
    assert report["weighted avg"].support == 3


def test_no_rows(spark):
    empty = spark.createDataFrame([], "label int, prediction int")
    assert E.weighted_metrics(E.confusion(empty), ()).first().accuracy is None


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    sides = [
        {r.id for r in S.hash_split(ids.repartition(n)).where("split = 'train'").collect()}
        for n in (1, 4)
    ]
    assert sides[0] == sides[1] and 750 < len(sides[0]) < 850
    train, test = S.random_split(ids)
    assert train.count() + test.count() == 1000


def test_poisson_weights(spark):
    assert poisson_cuts(0.1)[0] == math.floor(math.exp(-0.1) * 2**32)
    n = 20_000
    w = S.bootstrap_weights(spark.range(n).repartition(4), replicates=3)
    sums = {r.rep: r.s for r in w.groupBy("rep").agg(F.sum("weight").alias("s")).collect()}
    assert sums.keys() == {1, 2, 3}
    for s in sums.values():
        assert abs(s - 0.1 * n) < 5 * math.sqrt(0.1 * n)
    assert w.where("weight < 1").count() == 0
    twice = w.where("weight = 2").count() / (3 * n)
    assert abs(twice - math.exp(-0.1) * 0.1**2 / 2) < 0.002


def test_bootstrap_is_weighted_metrics_of_the_drawn_rows(scored):
    got = {(r.rep, r.metric): r.value for r in C.bootstrap_metrics(scored).collect()}
    assert len(got) == 20
    drawn = S.bootstrap_weights(scored).where("rep = 2")
    rows = drawn.select("label", "prediction", F.explode(F.array_repeat(F.lit(1), F.col("weight").cast("int"))))
    want = E.weighted_metrics(E.confusion(rows)).first()
    for m in ("accuracy", "precision", "recall", "f1"):
        assert got[(2, m)] == pytest.approx(want[m])


def test_summary_equals_numpy(scored):
    metrics = C.bootstrap_metrics(scored, replicates=7)
    values = {}
    for r in metrics.collect():
        values.setdefault(r.metric, []).append(r.value)
    for r in C.bootstrap_summary(metrics).collect():
        v = values[r.metric]
        assert (r["mean"], r["std"], r.p025, r.p975) == pytest.approx(
            (np.mean(v), np.std(v), np.percentile(v, 2.5), np.percentile(v, 97.5))
        )


def test_p_value_equals_erfc(spark):
    zs = [i / 7 for i in range(-140, 141)] + [2.8284, 2.8285, 1e-9, 20.0, 36.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in rows.select("z", two_sided_p(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=1e-11)
    assert rows.select(two_sided_p(F.lit(None).cast("double")).alias("p")).first().p is None


def runs(spark, rows):
    out = []
    for run, (day, mean, std) in rows.items():
        for m in ("accuracy", "precision", "recall", "f1"):
            out.append(("e", run, datetime(2024, 1, day), m, mean, std))
    return spark.createDataFrame(out, "experiment string, run_id string, start_time timestamp, metric string, mean double, std double")


def test_verdicts(spark):
    table = runs(spark, {"a": (1, 0.5, 0.0), "b": (2, 0.5, 0.0), "c": (3, 0.9, 0.01), "d": (4, 0.905, 0.01)})
    broken = table.where("run_id <> 'c' or metric <> 'f1'")
    got = {r.run_id: r for r in C.compare_runs(table).where("metric = 'f1'").collect()}
    assert got["a"].verdict is None and got["a"].z_score is None
    assert got["b"].z_score is None and got["b"].verdict is None
    assert got["c"].verdict == "significant"
    assert got["d"].verdict == "not significant"
    kept = {r.run_id: r for r in C.compare_runs(broken).where("metric = 'accuracy'").collect()}
    assert "c" not in kept and kept["d"].prev_mean == 0.5
    text = {r.run_id: r.report for r in C.verdict_text(C.compare_runs(table)).where("metric = 'f1'").collect()}
    assert text["a"] is None and "did not change" in text["d"] and " changed " in text["c"]


def test_md5_bucket_range(spark):
    got = spark.range(500).select(md5_bucket(1, 10, F.col("id")).alias("b")).distinct().collect()
    assert {r.b for r in got} == set(range(10))
