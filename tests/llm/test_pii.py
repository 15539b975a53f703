import random
import re
import time

from pyspark.sql import functions as F

from ticket_topics.llm import pii

from .frames import AWKWARD, awkward, clashing, empty

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    found += [
        ("card", *m.span())
        for m in CARD.finditer(text)
        if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))
    ]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def base(text):
    return [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]


def test_base_kinds_are_the_patterns():
    pick = random.Random(1)
    atoms = [*"0123456789" * 2, " ", "-", ".", "@", "+", "(", ")", "a", "é", "٣", "\U0001f600"]
    atoms += ["4111111111111111", "1.2.3.4", "a@b.c", "+1 (838) 555-9577", "account", "://", "0000"]
    for _ in range(30_000):
        text = "".join(pick.choices(atoms, k=pick.randint(1, 30)))
        assert base(text) == brute(text), text


def test_very_long_runs():
    for text in ("1" * 50_000, "1." * 20_000, "a" * 50_000 + "@", "+1" + " " * 50_000, "@" * 20_000):
        assert base(text) == brute(text)


def test_added_kinds():
    text = 'see https://bob:pw@host.org/x or mailto:a@b.org, tel:+4930123456; token = "ab12cd34ef56"'
    kinds = {k: text[a:b] for k, a, b in pii.find_spans(text)}
    assert kinds["account"] == "ab12cd34ef56"
    addresses = [text[a:b] for k, a, b in pii.find_spans(text) if k == "address"]
    assert addresses == ["https://bob:pw@host.org", "mailto:a@b.org", "tel:+4930123456"]
    assert pii.find_spans("a plain http://site.org/path and an account of things") == []


def accounts(text):
    return [text[a:b] for k, a, b in pii.find_spans(text) if k == "account"]


def test_identifiers_run_to_their_end():
    for cue, identifier in (
        ("token=", "a1b2" * 50), ("iban: ", "DE89 3704 0044 0532 0130 00"),
        ("IBAN ", "GB29NWBK60161331926819"), ("account: ", "1234 5678 9012"),
        ("api_key=", "sk_live_51Habc123456"), ("secret: ", "AKIA1234+abcd/9999"),
        ("API Key: ", "ab12cd34"), ("API key ", "ab12cd34"), ("User ID: ", "u-123456"),
        ("Customer ID ", "C1234567"), ("Account Number: ", "12345678"), ("token: ", "abc.1234.x_y-z=="),
        ("token: ", "noble12345é678"), ("secret=", "/a+b1234/c"), ("password: ", "P@ss1234:w0rd"),
    ):
        for before, behind in (("", ""), ("İ ", " and so on"), ("see (", ") there"), ('"', '", 7'), ("x ", ". Then")):
            assert accounts(before + cue + identifier + behind) == [identifier], (cue, identifier, behind)
    text = "token=" + "a1b2" * 50 + "!"
    assert pii.mask(text, pii.find_spans(text)) == "token=<ACCOUNT>!"
    # not valid modulo 97, so no grouped IBAN; words are no identifiers
    assert accounts("iban: DE88 3704 0044 0532 0130 00") == []
    assert accounts("account 12345678 2nd floor") == ["12345678"]
    assert accounts("tokens 12345678, an account of 12345678") == []
    assert [k for k, *_ in pii.find_spans("MAILTO:a@b.org")] == ["address", "email"]


def test_secrets_with_few_digits():
    for text, found in (
        ("password: correcthorse", ["correcthorse"]), ("Password=Sommer!ab.", ["Sommer!ab"]),
        ("token: abcdef1", ["abcdef1"]), ("secret = 'abcdefgh'", ["abcdefgh"]),
        ('{"api_key": "abcdefgh", "token" : "ab12cd34"}', ["abcdefgh", "ab12cd34"]),
        ("{'password': 'abcdefgh'}", ["abcdefgh"]),
        ("secret: https://hooks.org/services/T0/ab", ["https://hooks.org/services/T0/ab"]),
        # words, code, too short, or no separator
        ("the secret: always stir", []), ("token = request.get(1)", []), ("password = get_word()", []),
        ("password: abc", []), ("password correcthorse", []), ("account: correcthorse", []),
        ("password:!!!!!!!!", []), ("token = a1.values[0]", []),
    ):
        assert accounts(text) == found, text


def test_leads():
    for lead in ("\t", " No. ", " no.: ", "\t:\t", " " * 40, " Number:\t", ' = "', "_id\t= ", '": "', "' : '"):
        assert accounts("Account" + lead + "12345678") == ["12345678"], lead
    assert accounts("account\n12345678") == []


def test_plain_addresses_years_and_dates_are_no_identifiers():
    for text in (
        "see account https://x.org/a/2020/01/02/page", "account: HTTP://x.org/12345678", "account 2019 2020 2021",
        "account 2019-2020", "token 2020-01-02", "token 2020/1/12.", "customer id 2021.12.31, and",
    ):
        assert accounts(text) == [], text
    assert accounts("account: 2019 2020 2021") == ["2019 2020 2021"]
    assert accounts("account 2019 2020 5021") == ["2019 2020 5021"]


def test_addresses_run_to_their_end():
    for text in ("tel:+" + "1" * 25, "tel:1" + "-2" * 5000, "a" * 50 + "://u:p@h.org", "x" * 5000 + "+1.-://u:p@h"):
        assert [(k, a, b) for k, a, b in pii.find_spans(text) if k == "address"] == [("address", 0, len(text))]
    assert [text for k, *_ in pii.find_spans("1://u:p@h") if k == "address"] == []


def test_many_cues_in_a_long_run():
    for part in ("token_", "token-", "password:", "token ", "token" + " " * 50, "password=a(", "x://"):
        began = time.process_time()
        pii.find_spans("token=" + part * 100_000)
        assert time.process_time() - began < 20, part
    assert accounts("token=" + "token_" * 100_000) == []


def test_mask_merges_overlaps():
    text = "x mailto:a@b.org y 10.0.0.1"
    assert pii.mask(text, pii.find_spans(text)) == "x <ADDRESS> y <IP>"
    assert pii.mask("", []) == ""


def test_frames(spark):
    for df in (awkward(spark), clashing(spark)):
        rows = pii.spans_of(df).select(
            "id", pii.span_text(F.col("spans")).alias("s"), pii.count_of(F.col("spans"), "email").alias("n")
        ).collect()
        want = sorted(
            (repr(i), ",".join(f"{k}:{a}:{b}" for k, a, b in pii.find_spans(t or ""))) for i, t, *_ in AWKWARD
        )
        assert sorted((repr(r.id), r.s) for r in rows) == want
        assert sum(r.n for r in rows) == 1
    masked = awkward(spark).select(pii.masked(F.col("text")).alias("t")).collect()
    assert sum(r.t is None for r in masked) == 2
    assert any(r.t is not None and "<EMAIL>" in r.t for r in masked)
    assert pii.spans_of(empty(spark)).count() == 0
