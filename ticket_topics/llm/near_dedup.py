"""Near duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles. Each of SKETCHES orders takes the
LEAST smallest shingles, told apart by their occurrence number, and joins them in the
order in which they stand in the text: two texts share a sketch when they share
shingles in the same order. Texts that share a sketch are candidates; two are near
duplicates when the longest common subsequence of their shingles is at least
SIMILARITY of all shingles (common / (first + second - common)). An alignment outside
the band that this allows cannot reach it.

Equal texts are one node. In each bucket every text is held against the smallest one;
then texts of a bucket that are not yet in one class are compared with each other in
blocks, inside tasks that give back only the links that join classes. So a group of
thousands costs about one comparison each, and no link between classes is left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_keys, skew_join
from ..session import staged
from .common import keep_rows, keyed_texts, slices, text_of
from .components import components

WORDS = 5
SIMILARITY = 0.8
SKETCHES, LEAST = 32, 4
# Texts of few shingles get sketches of one shingle besides: taking several out of
# a handful misses more often than out of many.
FEW_SHINGLES, SINGLE_SKETCHES = 16, 8
SHARED = 2  # texts alike share about 13 of 32 sketches; fewer than two: one in a million
# A block of a bucket: so many texts, or so many shingles in all.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1 << 20
SALTS = 64
CELLS = 1 << 21  # cells of a block of sketches
SEEN_DIGESTS = 200_000  # digests a task remembers before it starts anew

_random = np.random.default_rng(11)
WORD_FACTORS = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) * 2 + 1
ORDER_SALTS = _random.integers(1, 1 << 63, SKETCHES + SINGLE_SKETCHES, dtype=np.uint64)
PLACE_FACTORS = _random.integers(1, 1 << 63, LEAST, dtype=np.uint64) * 2 + 1
MIX_A, MIX_B = (np.uint64(f) for f in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def words_of(text):
    """Lower case, runs of ASCII white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of the five-word shingles in order; a text of fewer words is one."""
    words = text.split(" ") if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    ids = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    width = min(WORDS, len(ids))
    out = np.full(len(ids) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out += mixed(ids[k : len(ids) - width + 1 + k]) * WORD_FACTORS[k]
    return mixed(out)


def labelled(found: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number mixed in: all different."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(starts, len(ranked)))
    number = np.arange(len(ranked)) - np.repeat(starts, sizes)
    if not number.any():
        return found
    out = np.empty_like(found)
    out[order] = np.where(
        number > 0, mixed(ranked + number.astype(np.uint64) * MIX_A), ranked
    )
    return out


def sketch_keys(found: np.ndarray) -> np.ndarray:
    """One key per order; equal keys mean the same shingles in the same order."""
    n = len(found)
    if not n:
        return np.empty(0, dtype=np.int64)
    items = labelled(found)
    total = SKETCHES + (SINGLE_SKETCHES if n <= FEW_SHINGLES else 0)
    keys = np.empty(total, dtype=np.uint64)
    step = max(1, CELLS // n)
    for begin in range(0, total, step):
        orders = np.arange(begin, min(total, begin + step))
        ranks = mixed(items[None, :] ^ ORDER_SALTS[orders][:, None])
        for least in {LEAST, 1}:
            rows = np.flatnonzero((orders < SKETCHES) == (least == LEAST))
            take = min(least, n)
            if not len(rows):
                continue
            if take < n:
                picked = np.argpartition(ranks[rows], take - 1, axis=1)[:, :take]
            else:
                picked = np.broadcast_to(np.arange(n), (len(rows), n))
            picked = items[np.sort(picked, axis=1)]
            value = ORDER_SALTS[orders[rows]].copy()
            for k in range(take):
                value += mixed(picked[:, k]) * PLACE_FACTORS[k]
            keys[orders[rows]] = mixed(value)
    return keys.view(np.int64)


def band_width(n: int, m: int, least: float) -> int:
    """Greatest number of shingles outside the alignment of two texts that are alike."""
    return int((n + m) * (1 - least) / (1 + least) + 1e-9)


def banded_common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence that stays within the band of
    diagonals; 0 where the lengths alone differ by more."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return 0
    # equal ends belong to some longest common subsequence
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return head + tail
    width = 2 * band + 1
    padded = np.zeros(n + m + 2 * width + 2, dtype=np.uint64)
    inside = np.zeros(len(padded), dtype=bool)
    padded[band : band + m], inside[band : band + m] = b, True
    # row[k] is the best up to a[:i], b[: i + k - band]
    row = np.zeros(width + 1, dtype=np.int64)
    for i in range(n):
        match = (padded[i : i + width] == a[i]) & inside[i : i + width]
        new = np.maximum(row[1:], row[:-1] + match)
        row[:-1] = np.maximum.accumulate(new)
        row[-1] = 0
    return head + tail + int(row.max())


def _rising(places: list[int]) -> int:
    """Length of the longest rising subsequence of distinct numbers."""
    tails: list[int] = []
    for p in places:
        k = bisect_left(tails, p)
        tails[k : k + 1] = [p]
    return len(tails)


class Sequence:
    """The shingles of a text, with what comparisons need made once."""

    def __init__(self, words: str | np.ndarray):
        self.shingles = shingles(words) if isinstance(words, str) else words
        self.labelled = labelled(self.shingles)
        self._members: frozenset | None = None

    def __len__(self) -> int:
        return len(self.shingles)

    @property
    def members(self) -> frozenset:
        if self._members is None:
            self._members = frozenset(self.labelled.tolist())
        return self._members


def alike(a: Sequence, b: Sequence, least: float = SIMILARITY) -> float:
    """Similarity of two texts, 0 when it is below ``least``.

    The number of common labelled shingles bounds the common subsequence from above,
    those of them that stand in the same order bound it from below; the alignment
    decides between the two.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    needed = least * (n + m) / (1 + least) - 1e-9
    if min(n, m) < needed or len(a.members & b.members) < needed:
        return 0.0
    common, at_a, at_b = np.intersect1d(
        a.labelled, b.labelled, assume_unique=True, return_indices=True
    )
    found = _rising(at_b[np.argsort(at_a)].tolist())
    if found < len(common):
        band = band_width(n, m, least)
        found = max(found, banded_common(a.shingles, b.shingles, band))
    return found / (n + m - found) if found >= needed else 0.0


# --- nodes and sketches


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, int] = {}
    for batch in slices(batches, "words"):
        fresh = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("digest", "row")), strict=True)
        for i, (digest, row) in enumerate(rows):
            # a text's node is its smallest row; files may come in any order
            if seen.get(digest, row + 1) > row:
                seen[digest] = row
                fresh.append(i)
        if len(seen) > SEEN_DIGESTS:
            seen.clear()
        batch = batch.take(pa.array(fresh, pa.int64()))
        found = [shingles(t) for t in batch.column("words").to_pylist()]
        keys = [sketch_keys(f) for f in found]
        yield pa.RecordBatch.from_pydict(
            {
                "node": batch.column("row"),
                "n": pa.array([len(f) for f in found], pa.int32()),
                "keys": pa.array(keys, pa.list_(pa.int64())),
            }
        )


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "left", "right")), strict=True)
        known: dict[int, Sequence] = {}
        links = []
        for a, b, left, right in rows:  # sorted by a
            if a not in known:
                known = {a: Sequence(left)}
            if alike(known[a], Sequence(right)):
                links.append((a, b))
        yield _links(links)


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def star_links(led: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links ``a, b`` between the smallest text of each bucket and the others.

    A text that leads very many is copied once per salt, and its followers are spread
    over the salts.
    """
    pairs = staged(
        led.where("node <> leader")
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS))),
        "star-pairs",
    )
    right = texts.select(F.col("row").alias("b"), F.col("words").alias("right"))
    left = texts.select(F.col("row").alias("a"), F.col("words").alias("left"))
    copies = pairs.select("a", "salt").distinct().join(left, "a")
    both = pairs.join(right, "b").join(copies, ["a", "salt"])
    return both.select("a", "b", "left", "right").mapInArrow(_similar, "a bigint, b bigint")


def _resolved(table: pa.Table) -> pa.Table:
    """Links that join classes inside one block of a bucket, most promising pairs first."""
    rows = table.to_pydict()
    nodes = rows["node"]
    found = [Sequence(t) for t in rows["words"]]
    sizes = np.array([len(f) for f in found])
    # a text without the sketches of one shingle shares them with none
    keys = np.empty((len(nodes), SKETCHES + SINGLE_SKETCHES), dtype=np.int64)
    keys[:] = -1 - np.arange(len(nodes))[:, None]
    for i, k in enumerate(rows["keys"]):
        keys[i, : len(k)] = k
    sketch = rows["sketch"][0]
    first = np.array(rows["first"])
    parent = {c: c for c in rows["label"]}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    labels = np.array(rows["label"])
    for i in np.flatnonzero(first):
        same = keys == keys[i]
        # a pair belongs to the first sketch it shares
        here = (same.argmax(axis=1) == sketch) & (labels != labels[i])
        fits = np.minimum(sizes, sizes[i]) >= SIMILARITY * np.maximum(sizes, sizes[i]) - 1e-9
        shared = same.sum(axis=1)
        once = ~first | (np.arange(len(nodes)) > i)
        wanted = np.flatnonzero(here & fits & once & (shared >= SHARED))
        for j in wanted[np.argsort(-shared[wanted], kind="stable")]:
            a, b = root(rows["label"][i]), root(rows["label"][j])
            if a != b and alike(found[i], found[j]):
                parent[max(a, b)] = min(a, b)
                links.append((nodes[i], nodes[j]))
    return pa.Table.from_batches([_links(links)])


def class_links(
    led: DataFrame, nodes: DataFrame, texts: DataFrame, labels: DataFrame
) -> DataFrame:
    """Verified links between classes that share a bucket beyond its smallest text.

    The class of the smallest text is the main one. Texts of other classes, in blocks,
    meet each other and the blocks of the main class; main and main are one already.
    """
    wide = staged(
        led.where("node <> leader")
        .join(labels.select("node", F.col("label").alias("found")), "node", "left")
        .select(
            "key", "node", "size", "sketch", "leader", F.coalesce("found", "node").alias("label")
        ),
        "labelled-members",
    )
    main = labels.select(F.col("node").alias("leader"), F.col("label").alias("main"))
    lead = staged(
        wide.groupBy("key", "leader")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("size"),
        )
        .where("low <> high")
        .join(main, "leader", "left")
        .select("key", F.coalesce("main", "leader").alias("main"), "n", "size"),
        "mixed-buckets",
    )
    parts = staged(
        skew_join(
            wide.select("key", "node", "sketch", "label"),
            lead,
            "key",
            hot_keys(lead, "key"),
            "inner",
        ),
        "mixed-members",
    )
    blocks = F.ceil(
        F.greatest(F.col("n") / BLOCK_ROWS, F.col("size") / BLOCK_SHINGLES)
    ).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    placed = parts.withColumn("blocks", blocks).withColumn("block", block)

    def unit(i, kind, j, first):
        return F.struct(
            i.cast("int").alias("i"),
            F.lit(kind).alias("kind"),
            j.cast("int").alias("j"),
            F.lit(first).alias("first"),
        )

    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    mine, zero = F.col("block"), F.lit(0)
    of_other = F.concat(
        F.transform(every, lambda j: unit(mine, "main", j, True)),
        F.transform(F.filter(every, lambda j: j >= mine), lambda j: unit(mine, "other", j, True)),
        F.transform(F.filter(every, lambda i: i < mine), lambda i: unit(i, "other", mine, False)),
    )
    of_main = F.transform(every, lambda i: unit(i, "main", mine, False))
    other, small = F.col("label") != F.col("main"), F.col("blocks") == 1
    units = (
        F.when(small & other, F.array(unit(zero, "all", zero, True)))
        .when(small, F.array(unit(zero, "all", zero, False)))
        .when(other, of_other)
        .otherwise(of_main)
    )
    shown = placed.select("key", "node", "sketch", "label", F.explode(units).alias("unit"))
    rows = (
        shown.join(nodes.select("node", "keys"), "node")
        .join(texts.select(F.col("row").alias("node"), "words"), "node")
        .select("key", "unit.*", "node", "sketch", "label", "keys", "words")
    )
    return rows.groupBy("key", "i", "kind", "j").applyInArrow(_resolved, "a bigint, b bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, class_id, class_size, kept``: one row per input row.

    A class holds the texts that links of similarity 0.8 or more connect, equal texts
    with them; its id is its smallest document id (null ids last), and the row that
    bears it is kept (the first of rows that repeat it). Words are runs of characters
    other than ASCII white space, in lower case. Empty and null texts are equal to each
    other and to nothing else. An empty table gives no rows; other columns play no part.
    """
    return _groups(docs, id_col, text_col).drop("digest")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each class, the kept one, with all its columns."""
    kept = _groups(docs, id_col, text_col).where("kept")
    digest = F.unhex(F.sha2(words_of(text_of(text_col)), 256))
    return keep_rows(docs, kept, id_col, digest)


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _answer(*_classes(docs, id_col, text_col))


def _classes(docs: DataFrame, id_col: str, text_col: str):
    texts = keyed_texts(docs, id_col, text_col).select("id", words_of(F.col("text")).alias("words"))
    stored = staged(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.unhex(F.sha2("words", 256)).alias("digest"),
            "words",
        ),
        "near-texts",
    )
    rows = stored.select("row", "id", "digest")
    copies = staged(
        rows.groupBy("digest").agg(
            F.min("row").alias("node"),
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"),
            F.count(F.lit(1)).alias("n"),
        ),
        "distinct-texts",
    )
    sketched = stored.select("row", "digest", "words").mapInArrow(
        _sketched, "node bigint, n int, keys array<bigint>"
    )
    nodes = staged(sketched.join(copies.select("node"), "node", "left_semi"), "sketches")
    members = staged(
        nodes.select("node", "n", F.posexplode("keys").alias("sketch", "key")).select(
            "node", F.col("n").alias("size"), "sketch", F.xxhash64("sketch", "key").alias("key")
        ),
        "sketch-members",
    )
    buckets = staged(
        members.groupBy("key")
        .agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
        .where("n > 1"),
        "buckets",
    )
    led = staged(
        skew_join(members, buckets.select("key", "leader"), "key", hot_keys(buckets, "key"), "inner"),
        "led-members",
    )
    wanted = led.select(F.col("node").alias("row")).distinct()
    candidates = staged(
        stored.select("row", "words").join(wanted, "row", "left_semi"), "candidate-texts"
    )
    stars = staged(star_links(led, candidates), "star-links")
    labels = components(stars)
    rest = staged(class_links(led, nodes, candidates, labels), "class-links")
    if not rest.isEmpty():
        labels = components(stars.unionByName(rest))
    return rows, copies, labels


def _answer(rows: DataFrame, copies: DataFrame, labels: DataFrame) -> DataFrame:
    named = staged(
        copies.join(labels, "node", "left").select(
            "digest", "n", "least", F.coalesce("label", "node").alias("label")
        ),
        "labelled-texts",
    )
    classes = staged(
        named.groupBy("label").agg(
            F.min("least").alias("first"), F.sum("n").alias("class_size"), F.count(F.lit(1)).alias("texts")
        ),
        "classes",
    )
    of_text = staged(
        skew_join(
            named.select("digest", "n", "label"),
            classes.select("label", "first", "class_size"),
            "label",
            hot_keys(classes, "label", "texts"),
            "inner",
        ),
        "text-classes",
    )
    joined = skew_join(
        rows,
        of_text.select("digest", "first", "class_size"),
        "digest",
        hot_keys(of_text, "digest"),
        "inner",
    )
    return joined.select(
        "id",
        "digest",
        F.col("first.id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
