"""Anchored parsers against the patterns of the contract, run everywhere."""

import random
import re

from llm.pii import KINDS, anchors, find_pii, iban, luhn, mask, scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(CARD, text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        total = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(PHONE, text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


def test_base_kinds_are_the_leftmost_matches():
    automaton = anchors()
    rng = random.Random(1)
    alphabets = ["0123456789.", "0123456789 -", "ab@.-", "a1@.%é", "+0123456789 ().-", "+1@.a -é٣", "01. "]
    hits = 0
    for i in range(30000):
        text = "".join(rng.choice(alphabets[i % len(alphabets)]) for _ in range(rng.randrange(45)))
        want = base(text)
        hits += bool(want)
        assert [s for s in scan(text, automaton) if s[0] in KINDS[:4]] == want, text
    assert hits > 3000


def test_cards_and_addresses_at_their_limits():
    automaton = anchors()
    kinds = lambda t: [k for k, _, _ in scan(t, automaton)]
    assert luhn("4111111111111111") and kinds("4111 1111-1111 1111") == ["card"]
    assert kinds("4111111111111112") == [] and kinds("4111  1111 1111 1111") == []
    assert kinds("0" * 19) == ["card"] and kinds("0" * 20) == [] and kinds("0" * 15) == []
    assert kinds("255.0.00.000255") == ["ip"] and kinds("256.1.1.1 1.1.1.1") == ["ip"]
    assert scan("1.2.3.4.5.6.7.8", automaton) == [("ip", 0, 7), ("ip", 8, 15)]
    assert kinds("1." + "9" * 5000 + ".1.1") == []
    assert scan("a@b.c@d.e", automaton) == [("email", 0, 5)]
    assert scan("a@b.c.@d.e", automaton) == [("email", 0, 5), ("email", 5, 10)]


def test_added_kinds():
    automaton = anchors()
    text = "see https://bob:pw@db.example.org:5432/x."
    assert [(k, text[s:e]) for k, s, e in scan(text, automaton)] == [("email", "pw@db.example.org"), ("url", "https://bob:pw@db.example.org")]
    found = [s for s in scan("go ftp://bob:pw@host/x http://plain.org/a@b", automaton) if s[0] == "url"]
    assert found == [("url", 3, 20)]
    text = "Account no: 12-3456-78, my account: none, ACCT #AB1234567. IBAN: GB82WEST12345698765432 iban: GB82WEST12345698765433"
    assert [text[s:e] for k, s, e in scan(text, automaton) if k == "account"] == ["12-3456-78", "AB1234567", "GB82WEST12345698765432"]
    assert iban("DE89370400440532013000") and not iban("DE89370400440532013001") and not iban("")
    assert [s for s in scan("subaccount: 1234567 accounts: 1234567", automaton) if s[0] == "account"] == []


def test_rows_texts_and_columns_of_every_sort(spark):
    long = "x " * 200_000 + "mail me@example.com " + "7" * 300_000 + " end 10.0.0.1"
    rows = [(1, "é a@b.cd +1 (555) 123-4567", "en", "s", 1), (1, "é a@b.cd +1 (555) 123-4567", "en", "s", 1), (2, None, None, None, None),
            (None, "", "en", "s", 0), (3, "plain words", "en", "s", 0), (4, long, "en", "s", 0), (5, "é" * 9 + "\U0001F600 1.2.3.4", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("spans", "_text", "redacted", "kind"):
        docs = docs.selectExpr("*", f"1 as {name}")
    out = find_pii(docs.repartition(3), redacted=True).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: ([tuple(s) for s in r["spans"]], r["redacted"]) for r in out}
    assert by_id[1] == ([("email", 2, 8), ("phone", 9, 26)], "é [email] [phone]")
    assert by_id[2] == ([], None) and by_id[None] == ([], "") and by_id[3] == ([], "plain words")
    assert [k for k, _, _ in by_id[4][0]] == ["email", "ip"] and by_id[4][1].endswith("end [ip]")
    assert by_id[5][0] == [("ip", 11, 18)]
    assert find_pii(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mask_joins_overlaps():
    assert mask("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a[x]f" and mask("abc", []) == "abc"
