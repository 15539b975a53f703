import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ticket_topics.llm import bpe, packing, token_counts
from ticket_topics.session import scratch_path

from .frames import AWKWARD, awkward, clashing, empty

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ATOMS = [
    " ", "  ", "\n", "\t", "a", "é", "Ü", "'s", "'ll", "1", "٣", "!", "\u0085", "\x1c",
    "日", "\U0001f600", "the", "<|endoftext|>", "<|startoftext|>", "ß", "Ā", "́",
    "İ", "Σ", "word", " ing",
]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    made = ["".join(pick.choices(ATOMS, k=pick.randint(0, 40))) for _ in range(3000)]
    return [*made, "", " ", "x" * 500, "the" * 400 + " " + "é" * 300]


def library(path):
    model = Tokenizer.from_file(path)
    model.no_padding()
    model.no_truncation()
    return model


def test_byte_bpe_is_the_library_and_back(texts):
    vocab, model = bpe.vocabulary(BYTES), library(BYTES)
    ids = bpe.encode_batch(pa.array(texts), vocab)
    want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    assert ids.to_pylist() == want
    decoded = bpe.decode_batch(ids, vocab).to_pylist()
    assert decoded == [model.decode(i, skip_special_tokens=False) for i in want] == texts


def test_long_words_merge_as_short_ones_do():
    vocab = bpe.vocabulary(BYTES)
    for word in (b"abcabcabc" * 5, b"theingtion" * 6, b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"):
        short = vocab.encode_words([word.decode()])[0]
        assert vocab._merge_long(word).tolist() == short.tolist()


def test_encode_frames(spark):
    model = library(BYTES)
    for df in (awkward(spark), clashing(spark)):
        rows = bpe.encode(df, BYTES, decoded=True).collect()
        got = sorted((repr(r.id), r.ids, r.decoded) for r in rows)
        want = sorted(
            (repr(i), model.encode(t or "", add_special_tokens=False).ids, t or "")
            for i, t, *_ in AWKWARD
        )
        assert got == want
        again = bpe.encode(df, BYTES).withColumn("text", bpe.decode(BYTES)("ids"))
        assert sorted(r.text for r in again.collect()) == sorted(w[2] for w in want)
    assert bpe.encode(empty(spark), BYTES).count() == 0


def test_ids_of_nulls_decode_to_null(spark):
    df = spark.createDataFrame([(None,), ([],), ([50256, 262],)], "ids array<int>")
    assert [r[0] for r in df.select(bpe.decode(BYTES)("ids")).collect()] == [
        None, "", "<|endoftext|> the",
    ]


def test_token_counts_and_the_cache(spark, monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cache = scratch_path(spark, "cache")
    want = sorted(
        (repr(i), len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096)
        for i, t, *_ in AWKWARD
    )
    for df in (awkward(spark), clashing(spark)):
        rows = token_counts.token_counts(df, PIECES, cache).collect()
        assert sorted((repr(r.id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    stored = spark.read.parquet(cache)
    # the second call found every text in the cache and appended nothing
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t, *_ in AWKWARD})
    # another tokenizer has counts of its own
    other = library(WORDS)
    rows = token_counts.token_counts(awkward(spark), WORDS, cache).collect()
    assert sorted((repr(r.id), r.n_tokens) for r in rows) == sorted(
        (repr(i), len(other.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in AWKWARD
    )
    assert token_counts.token_counts(empty(spark), PIECES, scratch_path(spark, "c")).count() == 0


def test_stored_counts_are_used(spark):
    cache = scratch_path(spark, "cache")
    digest = hashlib.sha256(b"known").digest()
    spark.createDataFrame(
        [(digest, token_counts.tokenizer_digest(PIECES), 77)], token_counts.CACHE_SCHEMA
    ).write.parquet(cache)
    df = spark.createDataFrame([(1, "known"), (2, "new")], "doc_id bigint, text string")
    rows = {r.id: r.n_tokens for r in token_counts.token_counts(df, PIECES, cache).collect()}
    assert rows[1] == 77 and 0 < rows[2] < 77


# --- packing


def test_word_ids_are_the_library(texts):
    flat, sizes = packing.token_ids(pa.array(texts), WORDS)
    ends = np.cumsum(sizes)
    model = library(WORDS)
    want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    assert [flat[e - s : e].tolist() for e, s in zip(ends, sizes, strict=True)] == want


def check_packing(rows, docs, limit):
    model = library(WORDS)
    pieces = {}
    for i, t, *_ in docs:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, start in enumerate(range(0, len(ids), limit)):
            part = ids[start : start + limit]
            key = (i, k, start, len(part), zlib.crc32(part.tobytes()))
            pieces[key] = pieces.get(key, 0) + 1
    got = {}
    sequences = {}
    for r in rows:
        key = (r.id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids)))
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == pieces
    for places in sequences.values():
        places.sort()
        end = 0
        for offset, length in places:
            assert offset == end
            end += length
        assert end <= limit
    return len(sequences)


def test_packing_frames(spark):
    for df in (awkward(spark), clashing(spark)):
        check_packing(packing.pack(df, WORDS).collect(), AWKWARD, 2048)
    assert packing.pack(empty(spark), WORDS).count() == 0


def test_packing_is_tight(spark):
    pick = random.Random(5)
    docs = [(i, " ".join(["the"] * pick.randint(1, 90))) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    used = check_packing(packing.pack(df, WORDS, limits=packing.Limits(tokens=100)).collect(), docs, 100)
    total = sum(len(t.split()) + 1 for _, t in docs)
    assert used <= -(-total // 100) * 1.02


def test_packing_of_a_table_sorted_by_length_is_tight(spark):
    pick = random.Random(6)
    sizes = [pick.randint(2, 20) for _ in range(12_000)] + [pick.randint(140, 240) for _ in range(6000)]
    docs = [(i, " ".join(["the"] * n)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2)
    limits = packing.Limits(tokens=256)
    used = check_packing(packing.pack(df, WORDS, limits=limits).collect(), docs, 256)
    _, at_once = packing.best_fit(np.array(sizes) + 1, limits)
    assert used <= len(at_once) * 1.02


def test_default_limits_weigh_every_demand():
    assert all(w > 0 for w in packing.Limits().weights)
    pick = np.random.default_rng(2)
    mixed = np.concatenate([pick.integers(20, 301, 2000), pick.integers(1100, 1901, 1000)])
    for lengths in (mixed, np.minimum(pick.lognormal(5.2, 0.9, 3000).astype(int) + 1, 2048)):
        tokens_alone = packing.Limits(weights=(1.0, 0.0, 0.0))
        used = len(packing.best_fit(lengths, packing.Limits())[1])
        assert used <= len(packing.best_fit(lengths, tokens_alone)[1])


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_limit_holds(rule):
    pick = np.random.default_rng(1)
    lengths = pick.integers(1, 100, 500)
    limits = packing.Limits(100, 4, 5000, (1.0, 0.5, 0.5), rule)
    bins, left = packing.best_fit(lengths, limits)
    for b in range(len(left)):
        inside = lengths[bins == b]
        assert inside.sum() + left[b] == 100
        assert len(inside) == 1 or (
            inside.sum() <= 100 and len(inside) <= 4 and (inside**2).sum() <= 5000
        )
    none, no_left = packing.best_fit(np.array([], dtype=np.int64), limits)
    assert len(none) == len(no_left) == 0
