import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticket_topics.llm import vptree as V
from ticket_topics.sources.tables import read_table

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, k):
    """Nearest usable rows of each query row: (query id, rank, id, score)."""
    usable = [
        (i, np.array(v, dtype=np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for i, v in usable:
        if i % every:
            continue
        near = [(j, V.cosine(v[None], w[None])[0]) for j, w in usable if j != i and len(w) == len(v)]
        near.sort(key=lambda n: (-n[1], n[0]))
        out += [(i, r + 1, j, s) for r, (j, s) in enumerate(near[:k])]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert [x[3] for x in a] == pytest.approx([x[3] for x in b], abs=1e-12)


def test_factor_one_is_exact(spark, sf):
    df = read_table(spark, sf, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    same(got(V.nearest(df, factor=1.0, shard_rows=120)), brute(rows, 50, 5))


def test_recall_of_the_production_factor(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    want = {x[:1] + x[2:3] for x in brute([(r.vec_id, r.embedding) for r in df.collect()], 50, 5)}
    found = {x[:1] + x[2:3] for x in got(V.nearest(df, shard_rows=500))}
    assert len(found & want) / len(want) >= 0.95


def test_recall_on_vectors_of_low_rank(spark):
    rng = np.random.default_rng(4)
    for rank in (4, 8, 16):
        points = V._unit(rng.normal(size=(4000, rank)) @ rng.normal(size=(rank, 64)))
        points = V._unit(points + 0.01 * rng.normal(size=points.shape) / 8)
        rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(points)]
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
        unit = V._unit(np.array([v for _, v in rows]))
        near = unit[::50] @ unit.T
        near[np.arange(len(near)), np.arange(0, len(unit), 50)] = -2
        want = {(50 * q, int(i)) for q, best in enumerate(np.argsort(-near)[:, :5]) for i in best}
        found = {x[:1] + x[2:3] for x in got(V.nearest(df))}
        assert len(found & want) / len(want) >= 0.95, rank


def test_pruning_skips_points():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 8))
    points = V._unit(np.repeat(centres, 50, axis=0) + 0.01 * rng.normal(size=(2000, 8)))
    ids = np.arange(2000)
    queries, own = points[::50], ids[::50]
    exact = V.Search(V.build(points), points, ids, queries, own, 5, 1.0)
    loose = V.Search(V.build(points), points, ids, queries, own, 5, 4.0)
    assert loose.visited <= exact.visited < 0.5 * len(queries) * len(points)
    assert (exact.found == loose.found).mean() > 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 0.0]),
        (50, [1.0, 0.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 2.0]), (150, [5.0]),
        (200, [1e30, 1e30]), (10, [1e-30, 0.0]), (11, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS)
    want = brute(rows, 50, 5)
    for frame in (df, df.select("*", F.lit(1).alias("row"), F.lit(2).alias("id"), F.lit("x").alias("vector"))):
        same(got(V.nearest(frame, factor=1.0, shard_rows=6)), want)
    assert V.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_repeated_rows_and_many_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [
        (i, rng.normal(size=3).tolist()) for i in range(400, 600)
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    same(got(V.nearest(df, factor=1.0, shard_rows=150)), brute(rows, 50, 5))
    twice = got(V.nearest(df.unionAll(df.where("vec_id = 0")), factor=1.0, shard_rows=150))
    assert [x[2] for x in twice if x[0] == 0] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
