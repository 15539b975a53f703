"""Links of near vectors against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticket_topics.llm import multi_index, queries

TABLE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, least=0.93):
    """``id, n_links, component_id, kept`` by all pairs, and the number of links."""

    def usable(v, label):
        return (
            label is not None
            and bool(v)
            and all(x is not None and math.isfinite(x) for x in v)
            and any(x != 0 for x in v)
        )

    n = len(rows)
    groups: dict = {}
    for i, (_, v, label) in enumerate(rows):
        if usable(v, label):
            groups.setdefault((label, len(v)), []).append(i)
    links = np.zeros(n, dtype=int)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for members in groups.values():
        x = np.array([rows[i][1] for i in members], dtype=np.float64)
        length = np.sqrt((x * x).sum(axis=1))
        near = (x @ x.T) / np.outer(length, length) >= least
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            links[[members[a], members[b]]] += 1
            p, q = root(members[a]), root(members[b])
            parent[max(p, q)] = min(p, q)
    lowest: dict = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            lowest[root(i)] = min(lowest.get(root(i), key), key)
    out = []
    for i, (key, _, _) in enumerate(rows):
        component = lowest.get(root(i))
        out.append((key, int(links[i]), component, key == component))
    return sorted(out, key=repr), int(links.sum())


def found_of(spark, rows, **options):
    df = spark.createDataFrame(rows, TABLE)
    return sorted(map(tuple, multi_index.near_vectors(df, **options).collect()), key=repr)


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def near_copies(rng, base, noise):
    v = base + noise * rng.standard_normal(len(base)) / math.sqrt(len(base))
    return v / np.linalg.norm(v)


def clustered(seed, groups, dimension=32):
    rng = np.random.default_rng(seed)
    rows = []
    for size, noise, label in groups:
        base = rng.standard_normal(dimension)
        base /= np.linalg.norm(base)
        rows += [(len(rows) + k, f32(near_copies(rng, base, noise)), label) for k in range(size)]
    return rows


def test_equals_all_pairs(spark):
    rows = clustered(1, [(300, 0.1, 1), (60, 0.25, 1), (60, 0.3, 2), (40, 0.37, 2), (150, 3.0, 1)])
    want, links = brute(rows)
    assert links > 2000 and found_of(spark, rows) == want


def test_large_cells_are_compared_in_blocks(spark, monkeypatch):
    rows = clustered(2, [(250, 0.1, 1), (120, 0.35, 1), (40, 0.2, 2)])
    want, _ = brute(rows)
    monkeypatch.setattr(multi_index, "BLOCK_VALUES", 32 * 30)
    assert found_of(spark, rows) == want
    # without groups counted by their centre every pair is compared
    monkeypatch.setattr(multi_index, "DENSE_SHARE", 0.5)
    assert found_of(spark, rows) == want


def test_copies_of_a_vector(spark):
    v, w = f32([1, 2, 3, 4]), f32([4, -3, 2, -1])
    rows = [(i, v, 1) for i in range(500)] + [(500 + i, w, 1) for i in range(20)]
    rows += [(700, [2 * x for x in v], 1), (701, v, 2), (0, v, 1), (None, v, 1), (None, w, 3)]
    assert found_of(spark, rows) == brute(rows)[0]


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1),
        (9, [1.0, 0.01], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.02, 0.0], 1), (12, [5.0], 1),
        (13, [3.0], 1), (14, [-3.0], 1), (None, None, None), (15, [1e-30, 0.0], 1), (16, [1e30, 0.0], 1),
    ]
    assert found_of(spark, rows) == brute(rows)[0]


def test_small_and_empty_tables(spark):
    assert found_of(spark, []) == []
    assert found_of(spark, [(4, [1.0, 2.0], 1)]) == [(4, 0, 4, True)]
    assert found_of(spark, [(4, None, 1)]) == [(4, 0, 4, True)]
    two = [(4, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)]
    assert found_of(spark, two) == [(3, 1, 3, True), (4, 1, 3, False)]


def test_clashing_columns_and_doubles(spark):
    rows = clustered(5, [(30, 0.2, 1), (30, 2.0, 1)])
    df = spark.createDataFrame(rows, TABLE).withColumn("embedding", F.col("embedding").cast("array<double>"))
    names = ["id", "row", "node", "digest", "n", "cell", "links", "kept", "component_id", "vector"]
    df = df.select("*", *[F.lit(n).alias(n) for n in names])
    found = sorted(map(tuple, multi_index.near_vectors(df).collect()), key=repr)
    assert found == brute(rows)[0]


@pytest.mark.parametrize("rank", [4, 16, 64])
def test_recall_at_the_threshold(spark, rank):
    """Partners just above the threshold, in vectors of low and of full rank."""
    rng = np.random.default_rng(rank)
    base = rng.standard_normal((3000, rank)) @ rng.standard_normal((rank, 64))
    base += 0.01 * rng.standard_normal(base.shape)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    to = base[rng.permutation(3000)[:600]] - 0
    to -= (to * base[:600]).sum(axis=1, keepdims=True) * base[:600]
    to /= np.linalg.norm(to, axis=1, keepdims=True)
    partners = 0.932 * base[:600] + math.sqrt(1 - 0.932**2) * to
    rows = [(i, f32(v), 1) for i, v in enumerate(np.concatenate([base, partners]))]
    want, links = brute(rows)
    found = found_of(spark, rows)
    assert sum(r[1] for r in found) >= 0.95 * links
    assert all(f[1] <= w[1] for f, w in zip(found, want, strict=True))


def test_traversal_takes_the_nearest_cells_in_order():
    rng = np.random.default_rng(3)
    first, second = rng.random((50, 7)), rng.random((50, 9))
    total = (first[:, :, None] + second[:, None, :]).reshape(50, -1)
    for visits in (1, 5, 20, 63):
        cells = multi_index.traverse(first, second, visits)
        assert (cells == np.argsort(total, axis=1, kind="stable")[:, :visits]).all()


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(1)
    more = [(10_000 + i, f32(near_copies(rng, np.array(v), 0.2)), label) for i, (_, v, label) in enumerate(rows[::5])]
    assert found_of(spark, rows + more) == brute(rows + more)[0]
    assert sorted(map(tuple, queries.op11_multi_index(spark, sf).collect()), key=repr) == brute(rows)[0]
