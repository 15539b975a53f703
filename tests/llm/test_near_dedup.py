import random
import re

import numpy as np
from pyspark.sql import functions as F

from ticket_topics.llm import near_dedup as N
from ticket_topics.llm.components import components
from ticket_topics.sources.tables import read_table

from .frames import AWKWARD, awkward, clashing, empty


def common_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", (text or "").lower()).strip(" ")


def brute_classes(rows):
    """Document classes by comparing all pairs of texts."""
    texts = {}
    for k, (i, text, *_) in enumerate(rows):
        texts.setdefault(normal(text), []).append(k)
    found = {t: N.Sequence(t) for t in texts}
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    every = sorted(texts)
    for x, a in enumerate(every):
        for b in every[x + 1 :]:
            if root(a) != root(b) and N.alike(found[a], found[b]):
                parent[root(b)] = root(a)
    classes = {}
    for t, places in texts.items():
        classes.setdefault(root(t), []).extend(places)
    out = []
    for places in classes.values():
        ids = sorted((rows[k][0] for k in places), key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), n == 0) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.id, r.class_id, r.class_size, r.kept) for r in df.collect()), key=repr)


def test_similarity_is_the_common_subsequence():
    pick = random.Random(2)
    for _ in range(1500):
        a = [pick.randint(0, pick.choice([2, 50])) for _ in range(pick.randint(1, 40))]
        b = a[:]
        for _ in range(pick.randint(0, 8)):
            k = pick.randrange(len(b))
            change = pick.random()
            if change < 0.4:
                b[k] = pick.randint(0, 50)
            elif change < 0.7 or len(b) == 1:
                b.insert(k, pick.randint(0, 50))
            else:
                del b[k]
        common = common_length(a, b)
        want = common / (len(a) + len(b) - common)
        score = N.alike(*(N.Sequence(np.array(x, dtype=np.uint64)) for x in (a, b)))
        assert (score > 0) == (want >= 0.8 - 1e-9)
        # with repeated shingles the bound from below may already decide
        assert score <= want + 1e-12


def test_sketches_agree_as_often_as_they_should():
    pick = random.Random(4)
    words = [f"w{pick.randint(0, 10**9)}" for _ in range(400)]
    near = words[:]
    for k in (50, 120, 200, 280, 350):
        near[k] = "changed"
    a, b = (N.sketch_keys(N.shingles(" ".join(w))) for w in (words, near))
    assert (a == b).sum() >= 8
    moved = " ".join(words[200:] + words[:200])
    # the same shingles in another order share few sketches
    assert (a == N.sketch_keys(N.shingles(moved))).sum() < (a == b).sum()


def test_every_link_of_a_hot_group(spark):
    """One base, hundreds of variants, many of them nearer to each other than to it."""
    pick = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 250):
        words = base[:]
        for _ in range(pick.randint(0, 7)):
            words[pick.randrange(150)] = f"v{pick.randint(0, 40)}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(f"u{pick.randint(0, 10**6)}" for _ in range(60))) for i in range(50)]
    passage = " ".join(f"p{k}" for k in range(55))
    docs += [(2000 + i, " ".join(f"q{i}x{k}" for k in range(80)) + " " + passage) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    want = brute_classes(docs)
    assert got(N.near_groups(df)) == want
    # the same in blocks of a few texts
    rows, copies, labels = N._classes(df, "doc_id", "text")
    assert got(N._answer(rows, copies, labels)) == want


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 7)
    test_every_link_of_a_hot_group(spark)


def test_whole_table(spark):
    df = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(N.near_groups(df)) == brute_classes(rows)


def test_awkward_rows(spark):
    want = brute_classes(AWKWARD)
    for df in (awkward(spark), clashing(spark)):
        assert got(N.near_groups(df)) == want
        kept = N.drop_near_duplicates(df)
        assert kept.columns == df.columns
        assert sorted(repr(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
            repr(w[0]) for w in want if w[3]
        )
    assert N.near_groups(empty(spark)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (102, 101), (7, 7)]
    star = [(500, i) for i in range(501, 900)]
    links = spark.createDataFrame(chain + star, "a bigint, b bigint")
    labels = {r.node: r.label for r in components(links).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)} | {i: 500 for i in range(500, 900)}
    assert labels == want
    assert components(links.where("a < 0")).count() == 0
    shuffled = links.orderBy(F.rand(1))
    assert {r.node: r.label for r in components(shuffled).collect()} == want
