import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm.catalog import QUERIES
from llm.suffix_dedup import _classes, repeated_in_families, suffix_dedup


def brute(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + window] for _, b in texts for s in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        dead, last = bytearray(len(b)), 0
        for s in range(len(b) - window + 1):
            if seen[b[s:s + window]] > 1:
                last = max(last, s)
                dead[last:s + window] = b"\1" * (s + window - last)
                last = s + window
        spans = sum(1 for k in range(len(b)) if dead[k] and (k == 0 or not dead[k - 1]))
        out.append((i, len(b), sum(dead), spans, bytes(c for c, d in zip(b, dead) if not d)))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    some = lambda n: "".join(rnd.choice("abcé \n\0") for _ in range(n))
    line = some(50)
    rows = []
    for i in range(80):
        t = some(rnd.randrange(0, 120))
        if i % 3 == 0:
            t = t[:40] + line[rnd.randrange(8):50 - rnd.randrange(8)] + t[40:]
        if i % 5 == 0:
            t = t + some(3) + t[-45:]
        if i % 7 == 0 and rows:
            t = rows[-1][1]
        if i % 9 == 0 and rows:
            old = rows[rnd.randrange(len(rows))][1]
            at = rnd.randrange(len(old) + 1)
            t = old[:at] + "#" + old[at + 1:]
        if i % 17 == 0:
            t = "ab" * 40 + t
        rows.append((i, t))
    return rows + [(None, None), (None, rows[2][1]), (4, rows[4][1]), (4, rows[4][1]), (900, ""), (901, "z" * 300)]


@pytest.mark.parametrize("seed,family", [(1, 512), (2, 3), (3, 1)])
def test_matches_brute_force(spark, seed, family):
    rows = corpus(seed)
    df = spark.createDataFrame([(a, b, b"x", 1) for a, b in rows], "doc_id long, text string, bytes binary, _v int").repartition(3)
    got = suffix_dedup(df, window=24, trigger=6, family=family)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    out = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got.collect()), key=str)
    assert out == brute(rows, 24)


def test_an_end_is_not_a_nul(spark):
    got = _classes([b"ab\0\0", b"ab", b"ab\0\0z"], np.zeros(3, np.int64), np.arange(1, 6))
    equal = [(c[0] == c[1], c[0] == c[2], c[1] == c[2]) for c in got.tolist()]
    assert equal == [(True,) * 3] * 2 + [(False, True, False)] * 2 + [(False,) * 3]
    rows = [(1, False, 0, 1, 2, b"xxab\0\0"), (1, False, 0, 1, 4, b"yyxxab"), (1, False, 0, 2, 2, b"xxab\0\0z")]
    assert [n.tolist() for n in repeated_in_families(rows, 6)] == [[0], [], [0]]


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query_on_the_whole_small_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in brute(rows, 200))
    got = sorted(tuple(r) for r in QUERIES["op2_suffix_array_dedup"](spark, d).collect())
    assert got == want and any(g[2] for g in got)


def test_every_long_is_an_id(spark):
    top = (1 << 63) - 1
    rows = [(top, "0123456789" * 3), (None, "x" + "0123456789" * 3), (top, None), (None, None), (-(1 << 63), "ab")]
    out = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), window=20, trigger=5).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in out) == sorted(
        [(str(top), 30, 30), ("None", 31, 30), (str(top), 0, 0), ("None", 0, 0), (str(-(1 << 63)), 2, 0)])


@pytest.mark.parametrize("family", [1, 8192])
def test_strings_that_differ_only_for_a_good_hash(spark, family):
    """Windows that hold 2,048 bytes and their complement: a polynomial hash modulo 2^64 takes
    them for equal."""
    from test_symbols import thue_morse

    one, two = thue_morse(2048)
    tail = "".join(f"{k:04d}" for k in range(40))
    rows = [(1, one + tail), (2, two + tail), (3, "x" + two + tail)]
    out = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), window=2100, trigger=60, family=family).collect()
    assert {r.doc_id: r.n_removed for r in out} == {1: 0, 2: len(two + tail), 3: len(two + tail)}
