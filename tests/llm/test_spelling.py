"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.frames import awkward, clashing, empty, plain
from tests.plans import explained
from ticket_topics.llm import queries, spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def brute(counts):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * counts[word] else None
    out = []
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        f = form[word]
        out.append((word, f, root, counts[word], len(near[word]), counts[f] if f else None))
    return sorted(out)


def grouped(spark, counts, **options):
    rows = spark.createDataFrame(list(counts.items()), "word string, times int")
    words = rows.select(F.explode(F.array_repeat("word", F.col("times"))).alias("word"))
    return sorted(map(tuple, spelling.group_variants(words, **options).collect()))


def made_up(seed, letters, number):
    rng = random.Random(seed)
    return {
        "".join(rng.choice(letters) for _ in range(rng.randint(5, 7))): rng.choice([3, 4, 8, 20])
        for _ in range(number)
    }


def test_equals_all_pairs(spark):
    counts = made_up(1, "abé", 250)
    assert grouped(spark, counts) == brute(counts)
    assert grouped(spark, counts, symbols=1) == brute(counts)


def test_chunks_of_one_reduced_word(spark, monkeypatch):
    counts = made_up(3, "abc", 150)
    monkeypatch.setattr(spelling, "CHUNK", 4)
    assert grouped(spark, counts, symbols=1) == brute(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "ccccc": 5}
    counts |= {"aaaac": 6, "xxxxx": 4, "xxxxy": 7}  # tie of two forms; less than twice
    found = {r[0]: r for r in grouped(spark, counts)}
    assert found["aaaaa"][1:3] == ("aaaab", "abbbb")
    assert found["ccccc"] == ("ccccc", None, "ccccc", 5, 0, None)
    assert found["xxxxx"][1] is None and found["xxxxx"][4] == 1
    assert sorted(found.values()) == brute(counts)


def test_other_alphabets_and_long_words(spark):
    counts = {"дерево": 9, "дерева": 3, "日本語文字": 8, "日本語文": 3, "日本語字字": 3, "x" * 3000: 6, "x" * 2999: 3}
    want = [r for r in brute({w: n for w, n in counts.items() if len(w) >= 5})]
    assert grouped(spark, counts) == want


def test_words_of_awkward_texts(spark):
    words = [tuple(r) for r in spelling.words_of(awkward(spark)).collect()]
    assert (8, "Ünï") in words and (None, "here") in words and (1, "seven") in words
    assert plain(spelling.words_of(clashing(spark))) == plain(spelling.words_of(awkward(spark)))
    assert spelling.group_variants(spelling.words_of(empty(spark))).count() == 0
    assert spelling.group_variants(spelling.words_of(awkward(spark))).count() == 0


def test_neighbourhood_is_complete(spark):
    row = spark.range(1).select(spelling.neighbourhood(F.lit("ab"), 2).alias("n")).first()
    want = {"ab", "a", "b", "bb", "aa", "aab", "bab", "abb", "aba"}
    assert set(row["n"]) == want and len(row["n"]) == len(want)


def test_query_equals_brute_force(spark, sf):
    counts = Counter()
    small = {c: c + 32 for c in range(65, 91)}
    for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            word = run.translate(small)
            h = zlib.crc32(f"{row['doc_id']}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    found = queries.op13_spelling_variants(spark, sf)
    assert sorted(map(tuple, found.collect())) == brute(kept)


def test_roots_broadcast_hot_keys_only(spark, monkeypatch):
    chains = [(f"w{i}", f"w{i // 2}") for i in range(1, 400)] + [(f"v{i}", "w5") for i in range(300)]
    forms = spark.createDataFrame([c for c in chains if c[0] != c[1]], "word string, form string")
    plans, staging = [], spelling.staged
    monkeypatch.setattr(spelling, "staged", lambda df, name: plans.append((name, explained(df))) or staging(df, name))
    found = dict(map(tuple, spelling.roots(forms).collect()))
    assert len(found) == 699 and set(found.values()) == {"w0"}
    rounds = [plan for name, plan in plans if name == "next-forms"]
    # all roots but the hot ones meet in a shuffle
    assert rounds and all("SortMergeJoin" in plan for plan in rounds)
