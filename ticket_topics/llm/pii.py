"""Personal data by anchors and local parsers.

One Aho-Corasick pass over a text finds at-signs, plus signs, schemes, digits and
identifier cues. Each anchor starts a deterministic parser that expands to the
boundaries of an address, a number or an account and validates what it found; text
without an anchor costs only the pass.

Kinds ``email, ip, card, phone`` follow fixed patterns: the leftmost matches that do
not overlap, those that fail their check dropped without a second try. ``address``
(``mailto:``, ``tel:``, or a URL that carries credentials) and ``account`` (an
identifier after a cue) are what the method adds. Cues and schemes are sought without
regard to case; a cue may be a quoted name, as in JSON. An identifier runs to its end,
however long it is, and holds six signs or more, of them four digits. Behind a cue for
secrets and ``:`` or ``=`` it needs fewer: none after ``password`` or in quotes, else one
digit among letters. Without such a separator years and dates are no identifiers, and a
plain URL is none unless it is given as a secret.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_letters

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

CUES = (
    "account", "acct", "iban", "token", "api_key", "apikey", "api key", "secret",
    "password", "passport", "ssn", "user id", "customer id", "konto", "cuenta", "compte",
)
SECRETS = frozenset(("token", "api_key", "apikey", "api key", "secret", "password"))
SCHEMES = ("mailto:", "tel:", "://")

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
RUN = re.compile(r"[0-9]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
CREDENTIALS = re.compile(r"[^\s/?#@:<>\"']+:[^\s/?#@<>\"']*@[A-Za-z0-9.-]+")
MAILTO = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
TEL = re.compile(r"\+?[0-9][0-9().-]{5,}[0-9]")
# between a cue and its identifier, in small letters
LEAD = re.compile(
    r"(?:[\x20\t_-]?(?:number|no|nr|id|key)(?![^\W_])\.?|[_-])?(?:[\"'](?=[\x20\t]*[:=]))?"
    r"[\x20\t]*([:=#]?)[\x20\t]*([\"']?)"
)
KEY = re.compile(r"[\w+/.~=%@$!*:^-]+")
GROUPS = re.compile(r"[0-9]+(?:[\x20-][0-9]+(?![^\W_]))*")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,30}")
YEARS = re.compile(r"(?:19|20)[0-9]{2}(?:[\x20-](?:19|20)[0-9]{2})*")
DATE = re.compile(r"(?:19|20)[0-9]{2}([/.-])[0-9]{1,2}\1[0-9]{1,2}")
URL = re.compile(r"(?:https?|ftps?|wss?|file|s3a?|gs)://")
SENTENCE = ".:!*"  # may follow an identifier, and does not end one
CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for digit in "0123456789":
        machine.add_word(digit, ("digit", 1))
    machine.add_word("@", ("at", 1))
    machine.add_word("+", ("plus", 1))
    for scheme in SCHEMES:
        machine.add_word(scheme, ("scheme", len(scheme)))
    for cue in CUES:
        machine.add_word(cue, ("cue", len(cue)))
    machine.make_automaton()
    return machine


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def lowered(text: str) -> str:
    """In small letters, each at its place: where one becomes two, only A-Z are changed."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(CAPITALS)


def iban_end(text: str, at: int) -> int:
    """End of the IBAN that begins at ``at``, grouped or not, valid modulo 97; else -1."""
    found = IBAN.match(text, at)
    end = found.end() if found else at
    while end - at >= 15:
        sign = text[end - 1]
        if sign not in " -" and not text[end : end + 1].isalnum():
            plain = re.sub("[ -]", "", text[at:end])
            if len(plain) < 15:
                return -1
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return end
        end -= 1
    return -1


class Identifiers:
    """The identifiers behind cues of one text. The run of key characters seen last is
    remembered, so cues inside a long one do not read it again."""

    def __init__(self, text: str, low: str):
        self.text, self.low = text, low
        self.begin = self.end = 0
        self.digits: list[int] = []

    def run_end(self, at: int) -> int:
        """End of the key characters from ``at`` on."""
        if not self.begin <= at < self.end:
            found = KEY.match(self.text, at)
            self.begin, self.end = at, found.end() if found else at
            self.digits = [k for k in range(at, self.end) if self.text[k].isdigit()]
        return self.end

    def behind(self, cue: str, after: int) -> tuple[int, int] | None:
        """Start and end of the identifier behind a cue that ends at ``after``."""
        text = self.text
        if text[after : after + 1].isalpha():
            return None
        lead = LEAD.match(self.low, after)
        start = lead.end()
        first = text[start : start + 1]
        if not (first.isalnum() or first and first in "_+/.~%@$!^-" and (lead[1] or lead[2])):
            return None
        secret = cue in SECRETS and lead[1] in (":", "=")
        if not secret and URL.match(self.low, start):
            return None
        end = iban_end(text, start)
        if end < 0:
            end = self.run_end(start)
            n = len(self.digits) - bisect_left(self.digits, start)
            groups = GROUPS.match(text, start)
            if groups and groups.end() > end:  # digits in groups, and what hangs on the last
                n = sum(c.isdigit() for c in groups[0])
                end = groups.end()
                if rest := KEY.match(text, end):
                    n += sum(c.isdigit() for c in rest[0])
                    end = rest.end()
            if n < 4 and not (secret and self.fits_secret(cue, lead[2], start, end, n)):
                return None
            while end > start and text[end - 1] in SENTENCE:
                end -= 1
            if not lead[1] and any(p.fullmatch(text, start, end) for p in (YEARS, DATE)):
                return None
        return (start, end) if end - start >= 6 else None

    def fits_secret(self, cue: str, quoted: str, start: int, end: int, digits: int) -> bool:
        """Whether a run of fewer than four digits is a secret: no call or lookup in code."""
        if self.text[end : end + 1] in ("(", "["):
            return False
        return bool(
            cue == "password"
            or quoted
            or digits
            and any(self.text[k].isalpha() for k in range(start, end))
        )


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` by start, then kind; code points, end exclusive."""
    spans: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    low = lowered(text)
    identifiers = Identifiers(text, low)
    for last, (kind, size) in anchors().iter(low):
        at = last - size + 1
        if kind == "digit":
            if at >= done["card"] and (found := DIGIT_CHAIN.match(text, at)):
                done["card"] = found.end()
                digits = found[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", at, found.end()))
            if at >= done["ip"]:
                chain = DOTTED.match(text, at)
                done["ip"] = chain.end()
                if "." in chain[0]:
                    runs = [(m.start(), m.end()) for m in RUN.finditer(text, at, chain.end())]
                    for k in range(0, len(runs) - 3, 4):
                        if all(_small(text[a:b]) for a, b in runs[k : k + 4]):
                            spans.append(("ip", runs[k][0], runs[k + 3][1]))
        elif kind == "plus":
            if at >= done["phone"] and (found := PHONE.match(text, at)):
                done["phone"] = found.end()
                if 9 <= sum(c in "0123456789" for c in found[0]) <= 15:
                    spans.append(("phone", at, found.end()))
        elif kind == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (found := DOMAIN.match(text, at + 1)):
                done["email"] = found.end()
                spans.append(("email", start, found.end()))
        elif kind == "scheme":
            spans += _address(text, at, last + 1, done)
        elif at >= done["account"] and (at == 0 or not text[at - 1].isalnum()):
            if found := identifiers.behind(low[at : last + 1], last + 1):
                done["account"] = found[1]
                spans.append(("account", *found))
    spans.sort(key=lambda s: (s[1], ORDER[s[0]]))
    return spans


def _address(text: str, at: int, after: int, done: dict[str, int]):
    if text[at] == ":":  # of "://": a scheme before it, credentials behind it
        start = at
        while start and text[start - 1] in SCHEME:
            start -= 1
        while start < at and text[start] not in ascii_letters:
            start += 1
        found = CREDENTIALS.match(text, after) if start < at else None
    elif at and text[at - 1].isalnum():
        return
    else:
        found = (MAILTO if text[at] in "mM" else TEL).match(text, after)
        start = at
    if found and start >= done["address"]:
        done["address"] = found.end()
        yield "address", start, found.end()


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans``: one row per input row, spans ``kind, start, end`` in order.

    Whole texts are searched; a null or empty text has no spans. Null and repeated
    ids stay as they are; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [find_spans(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(found)], ["id", "spans"])

    texts = keyed_texts(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    )


def _lists(found) -> pa.Array:
    offsets = [0]
    for spans in found:
        offsets.append(offsets[-1] + len(spans))
    flat = [s for spans in found for s in spans]
    columns = list(zip(*flat, strict=True)) or [(), (), ()]
    struct = pa.StructArray.from_arrays(
        [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
        names=["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind in angle brackets; overlaps become one mask
    that bears the kind of the first."""
    parts, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        parts += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join([*parts, text[done:]])


@lru_cache(maxsize=1)
def _masker():
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else mask(t, find_spans(t)) for t in texts.to_pylist()],
            pa.string(),
        )

    return run


def masked(text: Column) -> Column:
    """The text without its personal data; a null text stays null."""
    return _masker()(text)
