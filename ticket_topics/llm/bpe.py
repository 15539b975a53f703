"""Byte-level BPE by contiguous rank arrays, and its decoding.

Texts are cut at single spaces between other characters, where the split pattern
always cuts too; each batch encodes its distinct pieces once. A piece is split by
the public pattern into words. Words of one width stand in one matrix: a row holds
the part ids of a word and, beside them, the ranks of neighbouring parts. Every
round scans each row for its minimum rank, deletes that boundary and refreshes the
ranks of the two neighbours, for all rows at once. Words too wide for a matrix
merge through a heap, with the same result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, keyed_texts, ragged_take, slices

# Fixed value: the split pattern of the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NO_RANK = np.iinfo(np.int32).max
SHORT = 64  # bytes; longer words take the heap
WIDTHS = (4, 8, 16, 32, SHORT)
SLICE_TOKENS = 1 << 19  # decoded at a time (or one text)
CACHE_PIECES = 100_000  # pieces a worker remembers before it starts anew


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    spare = 256
    for b in range(256):
        if b not in printable:
            letters[chr(spare)] = b
            spare += 1
    return letters


class PieceIds:
    """The ids of pieces met before, in one flat array; emptied when it grows too large."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int32)
        self.sizes = np.empty(0, dtype=np.int64)
        self.starts = np.empty(0, dtype=np.int64)

    def take(self, codes: np.ndarray, distinct: list[str], encode):
        """Flat ids of the coded pieces and the number of each; ``encode`` gives the same
        for a list of new pieces."""
        slots = self.slots
        new = [p for p in distinct if p not in slots]
        if len(slots) + len(new) > self.limit:
            self.clear()
            slots, new = self.slots, distinct
        if new:
            flat, sizes = encode(new)
            self.flat = np.concatenate([self.flat, flat.astype(np.int32, copy=False)])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.starts = np.cumsum(self.sizes) - self.sizes
            slots.update(zip(new, range(len(slots), len(slots) + len(new)), strict=True))
        place = np.fromiter(map(slots.__getitem__, distinct), np.int64, len(distinct))
        return ragged_take(self.flat, self.starts, self.sizes, place[codes])


class Vocabulary:
    """Merge ranks, token bytes and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        tokens = [b""] * size
        for text, i in vocab.items():
            if all(c in letters for c in text):
                tokens[i] = bytes(letters[c] for c in text)
        for text, i in self.special.items():
            tokens[i] = text.encode()
        self.of_byte = np.zeros(256, dtype=np.int32)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = merged
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.split = regex.compile(SPLIT)
        self.known = PieceIds(CACHE_PIECES)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; NO_RANK where the pair does not merge."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word of the split pattern."""
        data = [w.encode() for w in words]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        out: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(data)
        below = 0
        for width in WIDTHS:
            rows = np.flatnonzero((sizes > below) & (sizes <= width))
            if len(rows):
                raw = np.frombuffer(b"".join(data[r].ljust(width) for r in rows), np.uint8)
                parts = self.of_byte[raw].reshape(len(rows), width)
                self._merge_rows(parts, sizes[rows], rows, out)
            below = width
        for r in np.flatnonzero(sizes > SHORT):
            out[r] = self._merge_long(data[r])
        return out

    def _merge_rows(self, parts, sizes, rows, out) -> None:
        width = parts.shape[1]
        columns = np.arange(width)
        ranks = np.full(parts.shape, NO_RANK, dtype=np.int32)
        if width > 1:
            ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        ranks[columns >= sizes[:, None] - 1] = NO_RANK
        while len(rows):
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            live = lowest != NO_RANK
            for r, n, ids in zip(rows[~live], sizes[~live], parts[~live], strict=True):
                out[r] = ids[:n].copy()
            parts, ranks, sizes, rows = parts[live], ranks[live], sizes[live], rows[live]
            if not len(rows):
                return
            at, every = at[live], np.arange(len(rows))
            # the boundary after part `at` goes: later parts and ranks move up
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, take, axis=1)
            parts[every, at] = self.merged[lowest[live]]
            take = np.minimum(columns + (columns >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, take, axis=1)
            sizes = sizes - 1
            ranks[columns >= sizes[:, None] - 1] = NO_RANK
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < sizes - 1))
                k = side[ok]
                ranks[ok, k] = self.rank(parts[ok, k], parts[ok, k + 1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        first = self.rank(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first < NO_RANK)]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # one of the two parts has merged meanwhile
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0:
                    found = int(self.rank(np.array([ids[a]]), np.array([ids[b]]))[0])
                    if found != NO_RANK:
                        heapq.heappush(heap, (found, a, ids[a], ids[b]))
        return np.array([i for i in ids if i >= 0], dtype=np.int32)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct pieces, and how many each has."""
        ids = self._encode_new(pieces)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return (np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)), sizes

    def _encode_new(self, pieces: list[str]) -> list[np.ndarray]:
        codes: dict[str, int] = {}
        taken: list[list[int]] = []
        whole = "\0".join(pieces)
        present = [s for s in self.special if s in whole]
        for piece in pieces:
            if present and any(s in piece for s in present):
                found = []
                for part in self.special_split.split(piece):
                    found += [part] if part in self.special else self.split.findall(part)
            else:
                found = self.split.findall(piece)
            taken.append([codes.setdefault(w, len(codes)) for w in found])
        words = list(codes)
        ids = self.encode_words([w if w not in self.special else "" for w in words])
        for special, i in self.special.items():
            if special in codes:
                ids[codes[special]] = np.array([i], dtype=np.int32)
        none = np.empty(0, dtype=np.int32)
        return [
            ids[w[0]] if len(w) == 1 else np.concatenate([ids[k] for k in w]) if w else none
            for w in taken
        ]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the tokens, and how many each has."""
        return ragged_take(self.flat, self.starts, self.sizes, ids)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path)


def _byte_classes() -> np.ndarray:
    """1 letter, 2 digit, 3 other visible ASCII; 0 the rest."""
    classes = np.zeros(256, dtype=np.uint8)
    for b in range(33, 127):
        classes[b] = 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
    return classes


CLASSES = _byte_classes()
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
APOSTROPHE = ord("'")


def pieces_of(
    texts: pa.Array, special: tuple[str, ...] = (), lower: bool = False
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Cut texts where the split pattern cuts whatever else they hold.

    That is before single spaces between plain characters (visible ASCII, or letters of
    two bytes below U+0100), and between ASCII letters, digits and signs, but not after
    an apostrophe, which may belong to the letter behind it. Where a special token
    occurs only spaces cut. With ``lower`` ASCII capitals become small first. Returns the
    number of pieces of each text, the code of each piece and the distinct pieces.
    """
    data = as_bytes(texts)
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[
        data.offset : data.offset + len(data) + 1
    ]
    raw = np.frombuffer(data.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    whole = raw.tobytes().lower() if special else b""
    plain = not any(token.encode().lower() in whole for token in special)
    if lower and plain:
        raw = LOWER[raw]
    spaces = np.flatnonzero(raw == 32)
    spaces = spaces[(spaces >= 2) & (spaces < len(raw) - 1)]
    ahead, behind, further = raw[spaces + 1], raw[spaces - 1], raw[spaces - 2]
    visible = CLASSES[ahead] > 0, CLASSES[behind] > 0
    letters = ahead == 0xC3, (behind >= 0x80) & (behind < 0xC0) & (further == 0xC3)
    cuts = [offsets, spaces[(visible[0] | letters[0]) & (visible[1] | letters[1])]]
    if plain:
        kinds = CLASSES[raw]
        change = (kinds[1:] != kinds[:-1]) & (kinds[1:] > 0) & (kinds[:-1] > 0)
        cuts.append(np.flatnonzero(change & (raw[:-1] != APOSTROPHE)) + 1)
    cuts = np.sort(np.concatenate(cuts), kind="stable")
    cuts = cuts[np.concatenate([[True], cuts[1:] > cuts[:-1]])]
    starts = np.searchsorted(cuts, offsets)
    pieces = pa.Array.from_buffers(
        pa.large_binary(),
        len(cuts) - 1,
        [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))],
    ).dictionary_encode()
    distinct = pieces.dictionary.cast(pa.large_string()).to_pylist()
    return np.diff(starts), pieces.indices.to_numpy(), distinct


def encode_batch(texts: pa.Array, vocab: Vocabulary) -> pa.Array:
    """Token ids of each text."""
    counts, codes, distinct = pieces_of(texts, tuple(vocab.special))
    ids, taken = vocab.known.take(codes, distinct, vocab.encode_pieces)
    ends = np.concatenate([[0], np.cumsum(taken)])
    offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """``id, ids``: the token ids of every whole text, one row per input row.

    Special tokens inside a text take their own id; nothing is added, cut or
    padded. A null or empty text has no ids; repeated rows and null ids stay as
    they are; an empty table gives no rows. ``path`` is the vocabulary file. With
    ``decoded`` the text that the ids stand for is a third column, made in the same
    pass; :func:`decode` does it for stored ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in slices(batches, "text"):
            ids = encode_batch(batch.column("text"), vocab)
            columns = {"id": batch.column("id"), "ids": ids}
            if decoded:
                columns["decoded"] = decode_batch(ids, vocab)
            yield pa.RecordBatch.from_pydict(columns)

    texts = keyed_texts(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + (", decoded string" if decoded else "")
    return texts.mapInArrow(run, schema)


def decode_batch(ids: pa.Array, vocab: Vocabulary) -> pa.Array:
    """The text of each array of ids; null for null."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    tokens = ids.flatten().to_numpy()
    ends = np.cumsum(sizes)
    nulls = ids.is_null().to_pylist()
    texts: list[str | None] = []
    while len(texts) < len(ids):  # so many rows at a time
        begin = len(texts)
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, side="right")))
        raw, taken = vocab.decode(tokens[before : int(ends[end - 1])])
        whole = raw.tobytes()
        bounds = np.concatenate([[0], np.cumsum(taken)])[ends[begin:end] - before]
        at = 0
        for null, stop in zip(nulls[begin:end], bounds.tolist(), strict=True):
            texts.append(None if null else whole[at:stop].decode("utf-8", "replace"))
            at = stop
    return pa.array(texts, pa.string())


def decode(path: str):
    """Arrow function from a column of ids to the texts they stand for.

    Special tokens are written out. Bytes that are no UTF-8, which only ids that do
    not come from a text can give, become replacement characters.
    """

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        return decode_batch(ids, vocabulary(path))

    return run
