import random
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ticket_topics.llm import pii, quality
from ticket_topics.sources.tables import read_table

from .test_near_dedup import brute_classes


def test_run_against_brute_force(spark, sf):
    docs = read_table(spark, sf, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, read_table(spark, sf, "labels"))
    scores = model.scores(np.stack([quality.count_terms(t) for t in rows.values()]))
    kept = [(i, t) for (i, t), s in zip(rows.items(), scores, strict=True) if s >= 0.3]
    assert len(kept) < len(rows)
    distinct = {}
    for i, t in sorted(kept):
        distinct.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    left = {w[0] for w in brute_classes(list(distinct.values())) if w[3]}
    texts = {i: pii.mask(rows[i], pii.find_spans(rows[i])) for i in left}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {p.doc_id for p in pieces} == left
    for i, text in texts.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.piece)
        ids = np.concatenate([np.frombuffer(bytes(p.ids), dtype="<u4") for p in own])
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert [p.start for p in own] == [2048 * k for k in range(len(own))]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 2048


def test_stages_keep_the_columns(spark, sf):
    docs = read_table(spark, sf, "documents")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.schema.simpleString() == docs.schema.simpleString()


def test_stages_take_awkward_rows(spark, sf):
    from .frames import awkward, empty

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward(spark), sf).count() > 0
        assert stage(spark, empty(spark), sf).count() == 0


def test_every_stage_takes_planted_cases(spark, sf):
    pick = random.Random(6)
    words = [f"{a}{b}" for a in ("ma", "ne", "ti", "so") for b in ("ra", "lo", "vi", "pe", "du")]
    base = " ".join(pick.choices(words, k=120)) + "."
    near = base.split(" ")
    near[60] = "other"
    docs = spark.createDataFrame(
        [(1, base), (2, base.replace(" ", "  ")), (3, " ".join(near)), (4, "call +1 (838) 555-9577 now")],
        "doc_id bigint, text string",
    ).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    docs = docs.withColumn("n_chars", docs.n_chars.cast("long"))
    stages = dict(corpus_pipeline.STAGES)
    exact = stages["exact_dedup"](spark, docs, sf)
    assert sorted(r.doc_id for r in exact.collect()) == [1, 3, 4]
    assert sorted(r.doc_id for r in stages["near_dedup"](spark, exact, sf).collect()) == [1, 4]
    masked = {r.doc_id: r for r in stages["personal_data"](spark, docs, sf).collect()}
    assert masked[4].text == "call <PHONE> now" and masked[4].n_chars == 16
    assert masked[1].text == base
