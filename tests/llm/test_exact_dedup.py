import hashlib
import re
from collections import Counter

from ticket_topics.llm import exact_dedup as X
from ticket_topics.session import staged

from .frames import AWKWARD, awkward, clashing, empty, plain


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(normal(row[1]), []).append(row[0])
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return out


def got(df):
    return [(r.id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()]


def test_awkward_rows_against_brute_force(spark):
    want = Counter(brute(AWKWARD))
    assert Counter(got(X.duplicate_groups(awkward(spark)))) == want
    assert Counter(got(X.duplicate_groups(clashing(spark)))) == want
    # many runs, several rounds
    spread = staged(awkward(spark).repartition(20), "spread")
    assert Counter(got(X.duplicate_groups(spread))) == want
    assert X.duplicate_groups(empty(spark)).count() == 0


def test_several_rounds_and_a_hot_text(spark):
    df = spark.range(0, 3000, 1, 70).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot text' ELSE concat('t', id % 700) END AS text"
    )
    rows = [tuple(r) for r in df.collect()]
    assert Counter(got(X.duplicate_groups(df))) == Counter(brute(rows))


def test_rows_that_stay_keep_all_columns(spark):
    kept = X.drop_duplicates(clashing(spark))
    assert kept.columns == clashing(spark).columns
    want = {(i, normal(t)) for i, t, *_ in AWKWARD}
    first = {}
    for i, t in want:
        first[t] = min(first.get(t, (9e9,)), (i is None and 1e9 or i, i))
    assert sorted(r[0] is None and -1 or r[0] for r in plain(kept.select("doc_id"))) == sorted(
        v[1] is None and -1 or v[1] for v in first.values()
    )
    assert X.drop_duplicates(empty(spark)).count() == 0
