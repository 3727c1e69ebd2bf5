"""Conversation repair against an exhaustive search and hand-made conversations."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from llm.conversation_repair import as_turns, audit_conversations, damage, repair_report, repaired_turns, search

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles: bytes, faults: bytes):
    """Uniform-cost search over (cost, edits): the first accepted is the cheapest, then the ASCII-least."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, last = heapq.heappop(heap)
        if i == len(roles) and last in ("", "a"):
            return cost, edits.encode()
        if (i, last) in done:
            continue
        done.add((i, last))
        nxt = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, edits + "I", i, nxt))
        if i < len(roles):
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, last))
            if faults[i] not in (1, 2):
                more = 5 * (faults[i] == 3)
                role = "sua?"[roles[i]]
                if role == nxt or (role == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, role))
                heapq.heappush(heap, (cost + 1 + more, edits + "R", i + 1, nxt))
    raise AssertionError


def test_search_is_cheapest_and_least():
    for n in range(4):
        for roles in itertools.product(range(4), repeat=n):
            for faults in itertools.product((0, 1, 3), repeat=n):
                assert search(bytes(roles), bytes(faults)) == cheapest(bytes(roles), bytes(faults))
    rng = random.Random(5)
    for _ in range(1500):
        n = rng.randrange(4, 25)
        roles = bytes(rng.choices(range(4), (1, 5, 4, 1), k=n))
        faults = bytes(rng.choices(range(4), (6, 1, 1, 2), k=n))
        assert search(roles, faults) == cheapest(roles, faults), (roles, faults)


def test_search_of_a_long_conversation():
    rng = random.Random(6)
    roles = bytes(rng.choices(range(4), (1, 5, 4, 1), k=20_000))
    faults = bytes(rng.choices(range(4), (6, 1, 1, 2), k=20_000))
    cost, edits = search(roles, faults)
    assert len(edits) >= 20_000 and (cost, edits) == cheapest(roles, faults)


def _report(rows):
    """The contract, row by row. Rows of one turn go by the digest that the operator documents."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        mode = zlib.crc32(key.encode()) % 20
        kept = convs.setdefault(conv, [])
        if mode == 1:
            text = ""
        elif mode == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif mode == 4:
            role = "user"
        same = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        if mode:
            kept += [(turn is not None, turn or 0, same, role, text)] * (2 if mode == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort()
        roles, faults, seen = [], [], set()
        for _, _, _, role, text in kept:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
            roles.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3))
        turns = {k[1] for k in kept if k[0]}
        pairs = [a[3][:1] + b[3][:1] for a, b in zip(kept, kept[1:])]
        cost, edits = cheapest(bytes(roles), bytes(faults))
        lines, last, i = [], "", 0
        for e in edits.decode():
            nxt = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append((nxt, ""))
            else:
                _, _, _, role, text = kept[i]
                i += 1
                if e == "D":
                    continue
                lines.append((nxt if e == "R" else role, text))
            last = lines[-1][0][:1]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, edits.decode(),
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def _random_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 2]), rng.choice(["system", "user", "user", "assistant", "tool", None, ""]),
                         rng.choice(["Yes.", "No!", "cut off", "", " \t", None, "same?", f"{conv} {turn}. ", "é.\x0b"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_report_matches_brute_force(spark, seed):
    rows = _random_rows(seed)
    got = repair_report(damage(spark.createDataFrame(rows, SCHEMA).repartition(7))).collect()
    want = _report(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r["conv"]], r


def test_one_conversation_with_a_third_of_all_rows(spark):
    rng = random.Random(3)
    rows = _random_rows(4) + [(7, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {t}."])) for t in range(20, 3000)]
    got = {r["conv"]: tuple(r)[1:] for r in repair_report(damage(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()}
    assert got == _report(rows)


def test_repaired_rows_have_the_form_and_clashing_columns_do_not_matter(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So?"), (1, 2, "user", "Well."), (2, 0, "system", "Be good."), (2, 1, "user", "Q?")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "same", "fault", "gone", "audit", "at", "nth"):
        df = df.selectExpr("*", f"1 as {name}")
    out = sorted(map(tuple, repaired_turns(as_turns(df)).collect()))
    # ties between the cheapest edits go to the ASCII-least: D before K and R
    assert out == [(1, 0, "user", "So?"), (1, 1, "assistant", "Well."), (2, 0, "user", "Be good."), (2, 1, "assistant", "Q?")]
    audits = {r["conv"]: (r["cost"], r["audit"], r["illegal"]) for r in audit_conversations(as_turns(df)).collect()}
    assert audits == {1: (3, "DKR", 1), 2: (2, "RR", 0)}


def test_empty_table_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_report(damage(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair_report(damage(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA))).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    far = repair_report(as_turns(spark.createDataFrame([(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")], SCHEMA))).first()
    assert far["gaps"] == (1 << 63) - 1 and far["audit"] == "KK"
