"""Runs of repeated words by Kruskal over suffix classes in descending order of LCP.

The suffixes of a text's words are sorted by prefix doubling, many texts at a time.
Neighbours in that order are united from the longest common prefix (LCP) to the
shortest. Each class keeps its positions in order; when two classes meet at a prefix
of l words, positions that become neighbours share exactly l words, so two of them at a
distance d within the bound start a stretch of period d and d + l words. If no word
before it extends it, it is a run, and d is its smallest period: a smaller one would
have put a position between the two earlier. Every run is met so, at its first position.

Texts that repeat no sequence of as many words as the shortest run needs hold no run
and are not sorted.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keyed_texts, slices
from .near_dedup import mixed

EXPONENT = 4  # a run is at least so many periods long
LEAST_WORDS = 6
MANY = 64  # classes of more positions are merged as arrays

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = f"id {{}}, n_words bigint, runs {RUNS}, collapsed string"


def least_prefix(exponent: int, least_words: int) -> int:
    """Fewest words that two suffixes one period apart share in a run."""
    return min(max((exponent - 1) * d, least_words - d) for d in range(1, least_words + 1))


def repeats(ids: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Texts in which some sequence of ``width`` words occurs twice."""
    n = len(ids) - width + 1
    if n < 2:
        return np.empty(0, dtype=np.int64)
    words = mixed(ids.astype(np.uint64) + np.uint64(1))
    key = mixed(text[:n].astype(np.uint64))
    for k in range(width):
        key = mixed(key + words[k : n + k])
    inside = np.flatnonzero(text[:n] == text[width - 1 :])
    key = key[inside]
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    return np.unique(text[inside[order[same]]])


def suffix_levels(ids: np.ndarray, text: np.ndarray, ends: np.ndarray):
    """Suffix order and, by prefix length 1, 2, 4 .., the rank of each position.

    Two positions of one text have the same rank at a length exactly when that many
    words are equal; positions of two texts never do. ``ends[p]`` is the end of p's text.
    """
    n = len(ids)
    key = text * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    key = key[order]
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    levels, length = [], 1
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        start = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        rank[order[slots]] = start
        levels.append((length, rank.astype(np.int32)))
        alone = first & np.append(first[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return order, levels
        here = order[slots]
        ahead = here + length
        # equal prefixes end inside their text, so at most one of them ends with it
        after = np.where(ahead < ends[here], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[here] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        key, order[slots] = key[by], here[by]
        length *= 2


def common_prefixes(first, second, levels, ends) -> np.ndarray:
    """Words that the suffixes at ``first`` and ``second`` have in common."""
    common = np.zeros(len(first), dtype=np.int64)
    last = len(ends) - 1
    for length, rank in reversed(levels):
        a, b = first + common, second + common
        inside = (a < ends[first]) & (b < ends[second])
        equal = rank[np.minimum(a, last)] == rank[np.minimum(b, last)]
        common += length * (inside & equal)
    return common


def unite(first, second, common, exponent: int, least_words: int) -> list[tuple[int, int, int]]:
    """``position, distance, prefix`` of the stretches met while classes are united.

    The edges come in descending order of their common prefix. The smaller class goes
    into the larger one.
    """
    places = np.unique(np.concatenate([first, second]))
    parent = list(range(len(places)))
    members: list = [[p] for p in places.tolist()]
    seeds = []
    ratio = exponent - 1
    edges = zip(
        np.searchsorted(places, first).tolist(),
        np.searchsorted(places, second).tolist(),
        common.tolist(),
        strict=True,
    )
    for a, b, shared in edges:
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        parent[b], members[b] = a, None
        reach = shared // ratio
        if len(small) > MANY:
            both = np.array(large + small)
            by = np.argsort(both, kind="stable")
            both, mine = both[by], by >= len(large)
            gap = np.diff(both)
            new = (mine[1:] != mine[:-1]) & (gap <= reach) & (gap + shared >= least_words)
            for k in np.flatnonzero(new).tolist():
                seeds.append((int(both[k]), int(gap[k]), shared))
            members[a] = both.tolist()
            continue
        at, before = 0, -1
        for k, place in enumerate(small):
            at = bisect_left(large, place, at)
            if at and (left := large[at - 1]) != before:
                gap = place - left
                if gap <= reach and gap + shared >= least_words:
                    seeds.append((left, gap, shared))
            if at < len(large):
                gap = large[at] - place
                if gap <= reach and gap + shared >= least_words:
                    if k + 1 == len(small) or small[k + 1] > large[at]:
                        seeds.append((place, gap, shared))
            large.insert(at, place)
            before = place
    return seeds


def runs_of(
    ids: np.ndarray,
    sizes: np.ndarray,
    exponent: int = EXPONENT,
    least_words: int = LEAST_WORDS,
) -> np.ndarray:
    """Rows ``text, start, length, period`` of all runs, by text, start and period.

    ``ids`` are the word numbers of all texts one after the other, ``sizes`` their counts.
    """
    least = least_prefix(exponent, least_words)
    empty = np.empty((0, 4), dtype=np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    wanted = repeats(ids, text, least)
    if not len(wanted):
        return empty
    chosen = np.zeros(len(sizes), dtype=bool)
    chosen[wanted] = True
    kept = chosen[text]
    ids, text = ids[kept], text[kept]
    counts = np.where(chosen, sizes, 0)
    ends = np.cumsum(counts)[text]
    own = (np.cumsum(counts) - counts)[text]
    order, levels = suffix_levels(ids, text, ends)
    # neighbours that share fewer words than the shortest run needs seed nothing
    floor = next(rank for length, rank in reversed(levels) if length <= least)
    near = np.flatnonzero(floor[order[1:]] == floor[order[:-1]])
    first, second = order[near], order[near + 1]
    common = common_prefixes(first, second, levels, ends)
    long_enough = np.flatnonzero(common >= least)
    by = long_enough[np.argsort(-common[long_enough], kind="stable")]
    seeds = unite(first[by], second[by], common[by], exponent, least_words)
    if not seeds:
        return empty
    place, period, shared = np.array(seeds, dtype=np.int64).T
    before = np.maximum(place - 1, 0)
    whole = (place == own[place]) | (ids[before] != ids[before + period])
    place, period, shared = place[whole], period[whole], shared[whole]
    rows = np.stack([text[place], place - own[place], period + shared, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _answer(batch: pa.RecordBatch, exponent: int, least_words: int) -> pa.RecordBatch:
    split = [text.encode().split() for text in batch.column("text").to_pylist()]
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    flat = pa.array([w for words in split for w in words], pa.large_binary())
    ids = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
    found = runs_of(ids, sizes, exponent, least_words)
    number = np.bincount(found[:, 0], minlength=len(sizes))
    ends = np.cumsum(number)
    for i in np.flatnonzero(number).tolist():
        rows = found[ends[i] - number[i] : ends[i]]
        step = np.zeros(sizes[i] + 1, dtype=np.int64)
        np.add.at(step, rows[:, 1] + rows[:, 3], 1)
        np.add.at(step, rows[:, 1] + rows[:, 2], -1)
        words = split[i]
        split[i] = [words[k] for k in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]
    runs = pa.StructArray.from_arrays(
        [pa.array(found[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"]
    )
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.RecordBatch.from_pydict(
        {
            "id": batch.column("id"),
            "n_words": pa.array(sizes),
            "runs": pa.ListArray.from_arrays(offsets, runs),
            "collapsed": pa.array([b" ".join(w).decode() for w in split], pa.string()),
        }
    )


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exponent: int = EXPONENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``id, n_words, runs, collapsed``: one row per input row, nothing shuffled.

    Words are separated by ASCII white space and numbered from 0. ``runs`` holds all
    stretches of at least ``exponent`` (2 or more) smallest periods and ``least_words``
    words that no neighbouring word extends, by start and period. ``collapsed`` is the
    text's words, joined by one space, without those that some run holds behind its first
    period. Null and empty texts have no words; ids may be null or repeat; an empty table
    gives no rows; other columns play no part. A text is worked on whole; a task needs
    about 200 bytes for each word of its longest text.
    """
    if exponent < 2:
        raise ValueError("exponent must be 2 or more")
    texts = keyed_texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield _answer(batch, exponent, least_words)

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, FOUND.format(kind))
