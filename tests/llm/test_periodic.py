"""Runs of repeated words against a search by definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import DOCS, awkward, clashing, empty, plain
from ticket_topics.llm import periodic, queries


def brute(words, exponent=4, least=6):
    """Every stretch of smallest period q that is long enough and not extendable."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(words[i : i + length - d] == words[i + d : i + length] for d in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts, exponent=4, least=6):
    ids = np.array([w for t in texts for w in t], dtype=np.int64)
    found = periodic.runs_of(ids, np.array([len(t) for t in texts]), exponent, least)
    out = [[] for _ in texts]
    for text, *run in found.tolist():
        out[text].append(tuple(run))
    return out


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 5)])
def test_equals_the_definition(exponent, least):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.choice([0, 1, 5, 6, 7, 12, 30, 60]), rng.choice([1, 2, 2, 3, 5])
            words = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                start, period = rng.randrange(n), rng.randint(1, 6)
                words = [w if i < start else words[start + (i - start) % period] if start + (i - start) % period < n else 0 for i, w in enumerate(words)]
                if rng.random() < 0.5:
                    words[rng.randrange(n)] = 9
            texts.append(words)
        assert runs_of(texts, exponent, least) == [brute(t, exponent, least) for t in texts]


def test_classes_of_many_positions_are_merged_alike(monkeypatch):
    rng = random.Random(2)
    texts = [[rng.randrange(2) for _ in range(800)] + [7] * 300 + [1, 2] * 200 for _ in range(3)]
    want = runs_of(texts)
    monkeypatch.setattr(periodic, "MANY", 2)
    assert runs_of(texts) == want == [brute(t) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 999])
def test_very_long_run(period):
    n = 200_000
    assert runs_of([[k % period for k in range(n)]]) == [[(0, n, period)]]


def test_awkward_texts(spark):
    rows = {r["id"]: r for r in periodic.periodic_runs(awkward(spark)).collect() if r["id"]}
    assert rows[2]["n_words"] == rows[3]["n_words"] == rows[7]["n_words"] == 0
    assert rows[2]["collapsed"] == "" and rows[2]["runs"] == []
    assert rows[5]["n_words"] == 60_000 and rows[5]["runs"] == []
    assert rows[4]["collapsed"] == "one two three four five six seven"
    assert periodic.periodic_runs(awkward(spark)).count() == awkward(spark).count()
    assert plain(periodic.periodic_runs(clashing(spark))) == plain(
        periodic.periodic_runs(awkward(spark))
    )
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_words_behind_the_first_period_go(spark):
    texts = ["x a b a b a b a b y", "z " + "q " * 7 + "é é " * 6, "a\x1fa a\x1fa"]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOCS)
    rows = {r["id"]: r for r in periodic.periodic_runs(df).collect()}
    assert rows[0]["collapsed"] == "x a b y"
    assert [tuple(r) for r in rows[0]["runs"]] == [(1, 8, 2)]
    assert rows[1]["collapsed"] == "z q é é"
    assert rows[2]["collapsed"] == "a\x1fa a\x1fa"


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force(spark, sf):
    found = queries.op12_periodic_runs(spark, sf).collect()
    texts = {
        r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
    }
    assert len(found) == len(texts) and any(r["n_runs"] for r in found)
    for row in found:
        words = planted(row["doc_id"], texts[row["doc_id"]])
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        assert tuple(row) == (
            row["doc_id"], len(runs), *best, milli,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(),
        )


def test_planting_keeps_odd_documents(spark):
    df = queries.with_planted_periods(awkward(spark))
    assert df.count() == awkward(spark).count()
    ten = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(ten[0], None), (ten[1], " \t"), (ten[2], "a b c d e f")]
    made = {
        r["doc_id"]: r["text"]
        for r in queries.with_planted_periods(
            spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit(1))
        ).collect()
    }
    assert made[ten[0]] == made[ten[1]] == ""
    assert made[ten[2]].split() == planted(ten[2], "a b c d e f")
