"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, pairs of
neighbouring digits, URL schemes and identifier cues. At every anchor that an earlier
match of its kind has not used up, a small local parser expands to the boundaries of
the candidate and checks it (parts of an address, digits and Luhn sum of a card,
length of a number, check digits of an IBAN). No pattern is ever tried anywhere else.

The base kinds give exactly the leftmost non-overlapping matches of their patterns: a
match of such a pattern holds an anchor, what stands left of the anchor is a maximal run
of the pattern's first class, and a candidate that fails its check uses up its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from llm._spark import ship

# The base kinds and what the method adds, in the order of the report.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

# Schemes whose URL may name a user, and cues that announce an identifier.
# Anchors are found in lower case, upper case and with a capital first letter.
SCHEMES = "amqp ftp http https imap ldap mongodb mysql postgres redis smtp ssh"
CUES = "account acct customer iban member passport patient policy ssn"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")

# What the local parsers read from an anchor on.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USER_HOST = re.compile(r"://[A-Za-z0-9._~%!$&*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9]")
NUMBER = re.compile(r"(?i:\x20?(?:number|no|id)\b\.?)?\x20?[:#=]\x20?([A-Za-z0-9-]+)")

CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)
ACCOUNT_CHARS = (6, 34)
ACCOUNT_DIGITS = 4  # the least an account has; words after a cue have none

SPAN = StructType([StructField("kind", StringType(), False), StructField("start", IntegerType(), False),
                   StructField("end", IntegerType(), False)])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def forms(word: str) -> tuple[str, ...]:
    return word, word.upper(), word.capitalize()


def anchors() -> ahocorasick.Automaton:
    """Anchor word -> (kind of parser, length of the word)."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for a in "0123456789":
        for b in "0123456789":
            found.add_word(f"{a}.{b}", ("ip", 3))
            for between in ("", " ", "-"):
                found.add_word(a + between + b, ("card", 2 + len(between)))
    for scheme in SCHEMES.split():
        for word in forms(scheme):
            found.add_word(f"{word}://", ("url", len(word) + 3))
    for cue in CUES.split():
        for word in forms(cue):
            found.add_word(word, ("account", len(word)))
    found.make_automaton()
    return found


def _run_start(text: str, at: int, least: int, allowed: frozenset) -> int:
    """Where the run of ``allowed`` characters that ends before ``at`` begins, ``least`` at the earliest."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban(code: str) -> bool:
    code = code.replace("-", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _within(n: int, bounds: tuple[int, int]) -> bool:
    return bounds[0] <= n <= bounds[1]


def _email(text: str, at: int, size: int, used: int):
    start = _run_start(text, at, used, LOCAL)
    domain = DOMAIN.match(text, at) if start < at else None
    return domain and (start, domain.end(), start, True)


def _ip(text: str, at: int, size: int, used: int):
    start = _run_start(text, at + 1, used, DIGITS)
    quad = QUAD.match(text, start) if start <= at else None
    return quad and (start, quad.end(), start, all(
        len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in quad.group().split("."))))


def _card(text: str, at: int, size: int, used: int):
    number = CARD.match(text, at)
    digits = number.group().replace(" ", "").replace("-", "")
    return at, number.end(), at, _within(len(digits), CARD_DIGITS) and luhn(digits)


def _phone(text: str, at: int, size: int, used: int):
    number = PHONE.match(text, at)
    return number and (at, number.end(), at, _within(sum(c in DIGITS for c in number.group()), PHONE_DIGITS))


def _url(text: str, at: int, size: int, used: int):
    rest = USER_HOST.match(text, at + size - 3)
    return rest and (at, rest.end(), at, True)


def _account(text: str, at: int, size: int, used: int):
    number = NUMBER.match(text, at + size) if at == 0 or text[at - 1] not in WORD else None
    if not number:
        return None
    code = number.group(1)
    if text[at:at + size].lower() == "iban":
        good = iban(code)
    else:
        good = _within(len(code), ACCOUNT_CHARS) and sum(c in DIGITS for c in code) >= ACCOUNT_DIGITS
    return number.start(1), number.end(), at, good


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "account": _account}


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start."""
    used = dict.fromkeys(KINDS, 0)
    found = {kind: [] for kind in KINDS}
    for last, (kind, size) in automaton.iter(text):
        at = last - size + 1
        if at < used[kind]:
            continue
        match = _PARSERS[kind](text, at, size, used[kind])
        if match:
            start, end, _, good = match
            used[kind] = end
            if good:
                found[kind].append((kind, start, end))
    return [span for kind in KINDS for span in found[kind]]


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans
    become one, named by the first."""
    out, done = [], 0
    for start, kind, end in sorted((s, k, e) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """Personal data of every whole text.

    Returns one row per input row: ``(<id_col>, spans)``, ``spans`` an array of ``(kind,
    start, end)`` in the order of ``KINDS``, then by start; positions are code points, end
    exclusive. With ``redacted`` also ``redacted``: the text with each span replaced by
    ``[kind]`` (null where the text is null).

    A null text counts as empty and has no spans; a null id stays null. Repeated rows and
    rows with one id are scanned one by one. An empty table gives an empty result. Other
    columns are ignored, whatever their names. Work and memory of a text grow with its
    length; rows never meet, so nothing is shuffled.
    """
    ship(docs.sparkSession)
    ids = docs.schema[id_col].dataType
    schema = StructType([StructField(id_col, ids), StructField("spans", ArrayType(SPAN, False))]
                        + ([StructField("redacted", StringType())] if redacted else []))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            spans, masked = [], []
            for raw in texts:
                text = raw.as_buffer().to_pybytes().decode("utf-8", "replace") if raw.is_valid else None
                spans.append(scan(text, automaton) if text else [])
                if redacted:
                    masked.append(None if text is None else mask(text, spans[-1]))
            rows = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in spans], pa.list_(_ARROW_SPAN))
            columns = [batch.column(0), rows] + ([pa.array(masked, pa.string())] if redacted else [])
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("_text")).mapInArrow(work, schema)


def labels(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))


# The patterns of the contract and of the two kinds that the method adds, as DuckDB reads them,
# and the group that is reported.
_ANY_FORM = lambda words: "|".join(f for w in words.split() for f in forms(w))
_SQL_KINDS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0),
    (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 0),
    (r"[0-9](?:[\x20-]?[0-9])+", 0),
    (r"\+[0-9][\x20().0-9-]+[0-9]", 0),
    (rf"(?:{_ANY_FORM(SCHEMES)})://[A-Za-z0-9._~%!$&*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9]", 0),
    (rf"(?:^|[^A-Za-z0-9])(?:{_ANY_FORM(CUES)})(?:\x20?(?i:number|no|id)\b\.?)?\x20?[:#=]\x20?([A-Za-z0-9-]+)", 1),
)
_SQL_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, {kind} AS kind, string_split_regex(t, '{regex}') AS pre, regexp_extract_all(t, '{regex}') AS w,
       regexp_extract_all(t, '{regex}', {group}) AS v FROM d"""
    for kind, (regex, group) in enumerate(_SQL_KINDS))

# y: the digits of a span, b: its letters and digits with the first four moved to the end, as numbers.
OP13_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({_SQL_MATCHES}),
u AS (SELECT doc_id, kind, unnest(range(0, len(w))) AS i, unnest(pre[1:len(w)]) AS pre, unnest(w) AS w, unnest(v) AS v FROM a),
s AS (SELECT doc_id, kind, w, v, regexp_replace(v, '[^0-9]', '', 'g') AS y, upper(replace(v, '-', '')) AS z,
             sum(len(pre) + len(w)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM u),
c AS (SELECT *, list_sum(list_transform(range(0, len(y)), lambda k: CASE WHEN k % 2 = 0 THEN substr(y, len(y) - k, 1)::INT
                ELSE substr(y, len(y) - k, 1)::INT * 2 - CASE WHEN substr(y, len(y) - k, 1)::INT > 4 THEN 9 ELSE 0 END END)) AS luhn,
             list_reduce(list_concat([0], list_transform(string_split(substr(z, 5) || substr(z, 1, 4), ''),
                lambda k: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', k) - 1)),
                lambda r, k: (CASE WHEN k > 9 THEN r * 100 + k ELSE r * 10 + k END) % 97) AS check97
      FROM s),
f AS (SELECT doc_id, kind, (stop - len(v))::BIGINT AS start, stop FROM c
      WHERE kind = 0 OR kind = 4
         OR (kind = 1 AND len(list_filter(string_split(v, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0)
         OR (kind = 2 AND len(y) BETWEEN 16 AND 19 AND luhn % 10 = 0)
         OR (kind = 3 AND len(y) BETWEEN 8 AND 15)
         OR (kind = 5 AND CASE WHEN regexp_matches(w, '^[^A-Za-z0-9]?(iban|IBAN|Iban)')
                THEN regexp_full_match(z, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND check97 = 1
                ELSE len(v) BETWEEN 6 AND 34 AND len(y) >= 4 END)),
k AS (SELECT *, ['email', 'ip', 'card', 'phone', 'url', 'account'][kind + 1] || ':' || start || ':' || stop AS label FROM f),
r AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip,
             count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
             string_agg(label, ',' ORDER BY kind, start) FILTER (WHERE kind < 4) AS base,
             string_agg(label, ',' ORDER BY kind, start) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
       coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""
