"""Conversation structure repair by iterative-deepening A*.

A conversation is read as a string of role initials that must become
``(s?(ua)+)?``. Edits: Delete a row, Insert an empty row, Keep a row, Rerole a row. The
search goes depth first through the edits in ASCII order (D, I, K, R) below a bound on the
cost, and raises the bound to the least cost that went beyond it until a path is
accepted; that first path is the answer: the cheapest edits, ties ASCII-least. Two
things keep it short:

* the estimate of the rest is the cost of the relaxed task whose string may end
  anywhere; what it misses is the last pair at most, so the bound rises a few times;
* the transposition table holds for every state (rows read, last role) that failed the
  least cost that its rest is known to need, and the search never enters it with less.

Rows reach the search sorted by conversation, as two bytes a row: a task holds the codes
and the table of one conversation, never its texts. The texts follow in a second
sorted stream, together with the found edits, and pass through one at a time.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from llm._spark import ship

# Costs of the edits, and what an undeleted truncated row adds.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5

# Fixed values of the damage.
DAMAGE_MODULUS = 20
DROP, EMPTY, STRIP, REPEAT, TO_USER = 0, 1, 2, 3, 4

SPACES = "\x20\t\n\x0b\f\r"
ENDINGS = (".", "!", "?")

_FINE, _BLANK, _DUPLICATE, _CUT, _GONE = range(5)  # first fault of a row; _GONE: no row after the damage
_NONE = 1 << 30
_MOST = (1 << 63) - 1
# what was read last: nothing, the system row, a user row, an assistant row
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ROLES = {"s": 0, "u": 1, "a": 2}
_OTHER = 3
_EDITS = b"DIKR"


def _target(q: int) -> int:
    """The only role that may follow: after a user row an assistant row, else a user row."""
    return _ASSISTANT if q == _USER else _USER


def _kept(q: int, role: int) -> int:
    """The state after a kept row, or -1 where the row cannot stand."""
    if role == 0:
        return _SYSTEM if q == _START else -1
    if role == 1:
        return -1 if q == _USER else _USER
    return _ASSISTANT if role == 2 and q == _USER else -1


_AFTER_KEEP = [[_kept(q, role) for role in range(4)] for q in range(4)]
_AFTER_TURN = [_target(q) for q in range(4)]


def _relaxed(roles: bytes, faults: bytes) -> array:
    """``4 * i + q``: cost of the rest where the string may end in any state."""
    n = len(roles)
    out = array("i", bytes(16 * (n + 1)))
    for i in range(n - 1, -1, -1):
        role, fault, base, nxt = roles[i], faults[i], 4 * i, 4 * i + 4
        extra = TRUNCATED if fault == _CUT else 0
        dead = fault in (_BLANK, _DUPLICATE)
        for q in range(4):
            best = DELETE + out[nxt + q]
            if not dead:
                best = min(best, REROLE + extra + out[nxt + _AFTER_TURN[q]])
                k = _AFTER_KEEP[q][role]
                if k >= 0:
                    best = min(best, KEEP + extra + out[nxt + k])
            out[base + q] = best
        # an inserted row moves to its target's state without reading a row; two of them never help
        user, assistant = out[base + _USER], out[base + _ASSISTANT]
        for q in (_START, _SYSTEM, _ASSISTANT):
            out[base + q] = min(out[base + q], INSERT + user)
        out[base + _USER] = min(user, INSERT + assistant)
    return out


def search(roles: bytes, faults: bytes) -> tuple[int, bytes]:
    """``(cost, edits)`` of the cheapest repair; of equal ones the ASCII-least. ``roles``:
    0 to 3 for s, u, a, any other; ``faults``: fine, blank, duplicate or cut."""
    n = len(roles)
    need = _relaxed(roles, faults)  # estimate, raised by every failure: the transposition table

    def move(i: int, q: int, edit: int) -> tuple[int, int, int]:
        """(rows read, state, cost) after an edit; cost _NONE where it is not allowed."""
        if edit == 1:
            return i, _AFTER_TURN[q], INSERT
        if i == n:
            return i, q, _NONE
        if edit == 0:
            return i + 1, q, DELETE
        fault = faults[i]
        if fault == _BLANK or fault == _DUPLICATE:
            return i, q, _NONE
        extra = TRUNCATED if fault == _CUT else 0
        if edit == 2:
            k = _AFTER_KEEP[q][roles[i]]
            return (i + 1, k, KEEP + extra) if k >= 0 else (i, q, _NONE)
        return i + 1, _AFTER_TURN[q], REROLE + extra

    while True:
        bound = need[0]
        states, edits = bytearray(), bytearray()
        i = q = spent = edit = 0
        while True:
            if i == n and q in (_START, _ASSISTANT):
                return spent, bytes(_EDITS[e] for e in edits)
            while edit < 4:
                i2, q2, cost = move(i, q, edit)
                if spent + cost + need[4 * i2 + q2] <= bound:
                    break
                edit += 1
            if edit < 4:
                states.append(q)
                edits.append(edit)
                i, q, spent, edit = i2, q2, spent + cost, 0
                continue
            # failed below this bound: what the state needs at least
            need[4 * i + q] = min(c + need[4 * a + b] for a, b, c in (move(i, q, e) for e in range(4)))
            if not edits:
                break
            q, edit = states.pop(), edits.pop()
            i -= edit != 1
            spent -= move(i, q, edit)[2]
            edit += 1


def damage(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, gone)``: the rows after a damage that the checksum of
    ``conversation:turn`` decides. A null role or text is one space, and so is a null
    conversation or turn in the checksum. A dropped row stays with ``gone`` set, so that no
    conversation is lost; a repeated row stands twice."""
    shown = lambda c: F.coalesce(convs[c].cast("string"), F.lit(" "))
    mode = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col))) % DAMAGE_MODULUS
    text = F.when(mode == EMPTY, "").when(mode == STRIP, F.regexp_replace(shown(text_col), "[.!?]", "")).otherwise(shown(text_col))
    rows = convs.select(
        convs[conv_col].cast("long").alias("conv"), convs[turn_col].cast("long").alias("turn"),
        F.when(mode == TO_USER, "user").otherwise(shown(role_col)).alias("role"), text.alias("text"),
        (mode == DROP).alias("gone"), F.when(mode == REPEAT, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("copy", "times")


def as_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """The undamaged rows in the form of ``damage``."""
    shown = lambda c: F.coalesce(convs[c].cast("string"), F.lit(" ")).alias(c)
    return convs.select(convs[conv_col].cast("long").alias("conv"), convs[turn_col].cast("long").alias("turn"),
                        shown(role_col).alias("role"), shown(text_col).alias("text"), F.lit(False).alias("gone"))


def _identity() -> Column:
    """Digest of role and text, told apart by the length of the role."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same")


def _initial() -> Column:
    return F.substring("role", 1, 1)


_AUDIT = StructType([StructField(c, LongType()) for c in ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    + [StructField("audit", StringType())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _audit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted stream of ``(conv, turn, initial, fault)``."""
    out: list[tuple] = []

    def flush(conv, roles, faults, first, last, turns, illegal):
        cost, edits = search(bytes(roles), bytes(faults))
        gaps = min(last - first + 1 - turns, _MOST) if turns else 0
        out.append((conv, gaps, faults.count(_BLANK), faults.count(_DUPLICATE), faults.count(_CUT), illegal, cost, edits.decode()))

    current, state = None, None
    for conv, turn, initial, fault in _chunks(batches):
        if state is None or conv != current:
            if state is not None:
                flush(current, *state[:-1])
                if len(out) >= 1000:
                    yield _batch(out, _AUDIT)
                    out = []
            # roles, faults, first and last turn, distinct turns, illegal pairs; initial of the row before
            current, state = conv, [bytearray(), bytearray(), 0, 0, 0, 0, None]
        if fault == _GONE:
            continue
        if turn is not None:
            if not state[4]:
                state[2] = state[3] = turn
                state[4] = 1
            elif turn != state[3]:
                state[3] = turn
                state[4] += 1
        if state[0] and state[6] + initial not in ("su", "ua", "au"):
            state[5] += 1
        state[0].append(_ROLES.get(initial, _OTHER))
        state[1].append(fault)
        state[6] = initial
    if state is not None:
        flush(current, *state[:-1])
    yield _batch(out, _AUDIT)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = {LongType(): pa.int64(), StringType(): pa.string(), BooleanType(): pa.bool_()}
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(columns, schema)], schema.fieldNames())


def audit_conversations(turns: DataFrame) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``, one row per
    conversation of ``turns`` (from ``damage`` or ``as_turns``): missing turn numbers, rows by
    first fault, neighbouring roles that may not follow each other, and the cheapest edits.

    Rows go by turn, null first; rows of one turn by a digest of role and text, so that
    equal ones are neighbours. A conversation whose rows are all gone has zeros and no
    edits; null is a conversation of its own; a role without characters fits nowhere.
    """
    ship(turns.sparkSession)
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = F.when(F.col("gone"), _GONE).when(last == "", _BLANK).when(~last.isin(*ENDINGS), _CUT).otherwise(_FINE)
    rows = turns.select("conv", "turn", _initial().alias("initial"), fault.alias("fault"), _identity())
    # earlier rows with the same role and text: narrow rows, sorted with spill
    seen = Window.partitionBy("conv", "same", F.col("fault") == _GONE).orderBy(F.asc_nulls_first("turn"))
    again = rows.withColumn("nth", F.row_number().over(seen)).withColumn(
        "fault", F.when((F.col("nth") > 1) & F.col("fault").isin(_FINE, _CUT), _DUPLICATE).otherwise(F.col("fault")))
    stream = again.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "same", "nth")
    return stream.select("conv", "turn", "initial", "fault").mapInArrow(_audit_rows, _AUDIT)


_STREAM = StructType([StructField("conv", LongType()), StructField("at", LongType()), StructField("role", StringType()),
                      StructField("text", StringType()), *[f for f in _AUDIT if f.name != "conv"]])
_STATS = [f.name for f in _AUDIT if f.name != "conv"]


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the edits through a sorted stream in which each conversation's audit comes first."""
    nothing = (None,) * len(_STATS)
    names = {_USER: "user", _ASSISTANT: "assistant"}
    edits, p, q, at, out, held = "", 0, _START, 0, [], 0
    conv = None

    def inserted():
        nonlocal p, q, at
        while p < len(edits) and edits[p] == "I":
            q = _AFTER_TURN[q]
            out.append((conv, at, names[q], "", *nothing))
            p, at = p + 1, at + 1

    for key, role, text, *stats in _chunks(batches):
        if stats[-1] is not None:
            inserted()  # what the conversation before ends with
            conv, edits, p, q, at = key, stats[-1], 0, _START, 0
            out.append((conv, -1, None, None, *stats))
        else:
            inserted()
            edit, p = edits[p], p + 1
            if edit != "D":
                q = _AFTER_TURN[q] if edit == "R" else _AFTER_KEEP[q][_ROLES.get(role[:1], _OTHER)]
                out.append((conv, at, names[q] if edit == "R" else role, text, *nothing))
                at, held = at + 1, held + len(text)
        if len(out) >= 2000 or held > 1 << 23:
            yield _batch(out, _STREAM)
            out, held = [], 0
    inserted()
    yield _batch(out, _STREAM)


def _repair_stream(turns: DataFrame) -> DataFrame:
    """Sorted by conversation inside each partition: its audit (``at`` = -1), then its
    repaired rows in order. Keeps that order as long as nothing is shuffled."""
    audits = audit_conversations(turns)
    head = audits.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("same"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *_STATS)
    rows = turns.where(~F.col("gone")).select("conv", "turn", _identity(), "role", "text", *[
        F.lit(None).cast(audits.schema[c].dataType).alias(c) for c in _STATS])
    stream = head.union(rows).repartition("conv").sortWithinPartitions(
        "conv", F.asc_nulls_last("audit"), F.asc_nulls_first("turn"), "same")
    return stream.select("conv", "role", "text", *_STATS).mapInArrow(_repaired_rows, _STREAM)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``(conv, at, role, text)``: the rows of every conversation after the cheapest edits, ``at``
    from 0. Input and order as for ``audit_conversations``; an empty table gives no rows."""
    return _repair_stream(turns).where("at >= 0").select("conv", "at", "role", "text")


_DIGEST = StructType([*_AUDIT, StructField("repaired_sha256", StringType())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    out, head, sha = [], None, None
    for conv, at, role, text, *stats in _chunks(batches):
        if at < 0:
            if head is not None:
                out.append((*head, sha.hexdigest()))
            head, sha = (conv, *stats), hashlib.sha256()
            if len(out) >= 1000:
                yield _batch(out, _DIGEST)
                out = []
        else:
            sha.update(f"{chr(10) if at else ''}{role}:{text}".encode("utf-8"))
    if head is not None:
        out.append((*head, sha.hexdigest()))
    yield _batch(out, _DIGEST)


def repair_report(turns: DataFrame) -> DataFrame:
    """The audit of every conversation and ``repaired_sha256``: the digest of its repaired rows
    as ``role:text``, joined by newlines, taken as they stream by."""
    return _repair_stream(turns).mapInArrow(_digests, _DIGEST)
