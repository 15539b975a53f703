"""Text quality by nearest-neighbour voting over latent-semantic vectors.

A text is counted as two bags of terms: hashed three-byte sequences, and the shapes of
its words (which kinds of characters a word holds, and whether it repeats the word
before) with their pairs. Both bags are weighted, brought to unit length and projected
on the leading singular vectors of a labelled sample. The sample's vectors are broadcast;
every text is compared with all of them by blocked matrix products, and its nearest
neighbours vote for their labels with their cosine as weight.

The sample is bounded: at most ``per_class`` texts of each label.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed_texts

PER_CLASS = 1000
NEIGHBOURS = 15
RANK = 48
FOLDS = 5  # the fold 0 of crc32(id) is held out
THRESHOLD = 0.3

TRIGRAM_BITS, PAIR_BITS = 11, 10
TRIGRAMS, SHAPES = 1 << TRIGRAM_BITS, 64
TERMS = TRIGRAMS + SHAPES + (1 << PAIR_BITS)
PART_BYTES = 1 << 20  # longer texts are counted part by part, cut at white space
BLOCK_ROWS = 256
HASHES = 1 << 40
TIE = 1e-6

MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LETTER_PLACES = 256
PLACE_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, LETTER_PLACES, dtype=np.uint64) | 1


def _byte_kinds() -> np.ndarray:
    """One bit each: small letter, capital, digit, punctuation, other sign."""
    kinds = np.full(256, 16, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.islower():
            kinds[b] = 1
        elif c.isupper():
            kinds[b] = 2
        elif c.isdigit():
            kinds[b] = 4
        elif c in ".,;:'\"?-()":
            kinds[b] = 8
    return kinds


KINDS = _byte_kinds()


def _parts(raw: np.ndarray):
    while len(raw) > PART_BYTES:
        space = np.flatnonzero(WHITE[raw[PART_BYTES // 2 : PART_BYTES]])
        cut = PART_BYTES // 2 + int(space[-1]) if len(space) else PART_BYTES
        yield raw[:cut]
        raw = raw[cut:]
    yield raw


def count_terms(text: str) -> np.ndarray:
    """How often each term occurs in the whole text."""
    counts = np.zeros(TERMS, dtype=np.float32)
    for raw in _parts(np.frombuffer(text.encode(), dtype=np.uint8)):
        if len(raw) >= 3:
            wide = raw.astype(np.uint32)
            hashed = (wide[:-2] * MIX[0]) ^ (wide[1:-1] * MIX[1]) ^ (wide[2:] * MIX[2])
            hashed = (hashed * MIX[3]) >> np.uint32(32 - TRIGRAM_BITS)
            counts[:TRIGRAMS] += np.bincount(hashed, minlength=TRIGRAMS)
        inside = ~WHITE[raw]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        if not len(starts):
            continue
        raw, inside = raw[starts[0] :], inside[starts[0] :]
        starts = starts - starts[0]
        shapes = np.bitwise_or.reduceat(np.where(inside, KINDS[raw], 0), starts)
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
        factors = PLACE_FACTORS[np.minimum(place, LETTER_PLACES - 1)]
        words = np.add.reduceat(np.where(inside, (raw + np.uint64(1)) * factors, 0), starts)
        repeated = np.concatenate([[False], words[1:] == words[:-1]])
        codes = shapes.astype(np.uint32) + np.uint32(32) * repeated.astype(np.uint32)
        pairs = (codes[:-1] * np.uint32(64) + codes[1:]) * MIX[0]
        counts[TRIGRAMS : TRIGRAMS + SHAPES] += np.bincount(codes, minlength=SHAPES)
        counts[TRIGRAMS + SHAPES :] += np.bincount(
            pairs >> np.uint32(32 - PAIR_BITS), minlength=1 << PAIR_BITS
        )
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


@dataclass(frozen=True)
class Model:
    """What a fit leaves: term weights, projection, the sample's vectors and labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def bags(self, counts: np.ndarray) -> np.ndarray:
        letters = np.log1p(counts[:, :TRIGRAMS]) * self.weights
        return np.concatenate([_unit(letters), _unit(np.sqrt(counts[:, TRIGRAMS:]))], axis=1)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest; all that tie with the last one
        vote. A text that resembles no labelled text gets the share in the sample."""
        base = self.labels.mean() if len(self.labels) else 0.5
        out = np.full(len(counts), base)
        if not len(self.labels):
            return out
        vectors = _unit(self.bags(counts) @ self.projection)
        alike = vectors @ self.vectors.T
        k = min(self.neighbours, alike.shape[1])
        last = np.partition(alike, -k, axis=1)[:, -k]
        votes = np.where(alike >= last[:, None] - TIE, np.maximum(alike, 0), 0)
        total = votes.sum(axis=1)
        voted = total > 0
        out[voted] = np.clip((votes @ self.labels)[voted] / total[voted], 0, 1)
        return out


def fit_counts(counts: np.ndarray, labels: np.ndarray, neighbours: int, rank: int) -> Model:
    """Latent-semantic vectors of a labelled sample."""
    seen = (counts[:, :TRIGRAMS] > 0).sum(axis=0)
    weights = (np.log((1 + len(counts)) / (1 + seen)) + 0.1).astype(np.float32)
    empty = np.zeros((0, rank), dtype=np.float32)
    model = Model(weights, empty, empty, labels.astype(np.float32), neighbours)
    if not len(counts):
        return model
    bags = model.bags(counts)
    # leading right singular vectors, by way of the texts x texts products
    values, axes = np.linalg.eigh((bags @ bags.T).astype(np.float64))
    lead = [a for a in np.argsort(values)[::-1][:rank] if values[a] > values[-1] * 1e-9]
    projection = (bags.T @ axes[:, lead] / np.sqrt(values[lead])).astype(np.float32)
    return Model(weights, projection, _unit(bags @ projection), model.labels, neighbours)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as the empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    per_class: int,
) -> DataFrame:
    """``id, text, label``: the first ``per_class`` ids of each label by a hash.

    Only labels 0 and 1 outside the held-out fold count; an id that bears both takes
    the lower. Of rows that repeat an id one text is taken.
    """
    learnt = (
        labels.where(fold(id_col) != 0)
        .where(F.col(f"`{label_col}`").isin(0, 1))
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.min(f"`{label_col}`").cast("int").alias("label"))
    )
    texts = keyed_texts(docs, id_col, text_col)
    known = learnt.join(texts.select("id"), "id", "left_semi")
    # the smallest hashes; a share of the hashes that holds four times as many goes first,
    # so that what meets in one task does not grow with the table
    place = F.pmod(F.xxhash64("id"), F.lit(HASHES))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    limit = F.lit(HASHES)
    for label, n in sizes.items():
        limit = F.when(F.col("label") == label, min(HASHES, 4 * per_class * HASHES // n)).otherwise(limit)
    first = Window.partitionBy("label").orderBy(place, "id")
    chosen = (
        known.where(place < limit)
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= per_class)
    )
    # at most two labels times per_class rows
    return (
        texts.join(F.broadcast(chosen.select("id", "label")), "id")
        .groupBy("id", "label")
        .agg(F.first("text").alias("text"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
    neighbours: int = NEIGHBOURS,
    rank: int = RANK,
) -> Model:
    """Learn from at most ``2 * per_class`` labelled texts; only their term counts, 12 kB
    each before compression, reach the driver. Without labelled texts every score is one
    half."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, per_class)

    def run(batches):
        for batch in batches:
            counted = [
                zlib.compress(count_terms(t).tobytes(), 1) for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(counted, pa.binary())],
                ["id", "label", "counts"],
            )

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.select("id", "label", "text").mapInArrow(
        run, f"id {kind}, label int, counts binary"
    )
    table = rows.toArrow().sort_by("id")
    counts = np.empty((table.num_rows, TERMS), dtype=np.float32)
    for i, packed in enumerate(table.column("counts")):
        counts[i] = np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.float32)
    return fit_counts(counts, table.column("label").to_numpy(), neighbours, rank)


def scorer(df: DataFrame, model: Model):
    """Arrow function from whole texts to scores; the model is broadcast once."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(texts), BLOCK_ROWS):
            block = texts.slice(at, BLOCK_ROWS).to_pylist()
            counts = np.stack([count_terms(t or "") for t in block])
            found.append(shared.value.scores(counts))
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return run


def score_quality(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id, held_out, score, predicted``, one row per input row.

    A null or empty text resembles nothing and gets the share of label 1 in the sample;
    null and repeated ids stay as they are; an empty table gives no rows.
    """
    score = scorer(docs, model)
    return (
        keyed_texts(docs, id_col, text_col)
        .select("id", (fold("id") == 0).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    return docs.where(scorer(docs, model)(F.col(f"`{text_col}`")) >= threshold)
