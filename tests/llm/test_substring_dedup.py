import hashlib
import random
import re

import pytest

from llm.catalog import QUERIES
from llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """rows: (id, text). Per row: (id, n_words, n_removed, kept)."""
    words = [(i, WORD.findall(t) if t else []) for i, t in rows]
    low = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            low[key] = min(low.get(key, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if low[tuple(w[s:s + window])] < ((1 << 63) - 1 if i is None else i):
                gone[s:s + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), " ".join(kept)))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "bb", "ccc", "dé", "e"]) + str(rnd.randrange(40))
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rnd.randrange(0, 60))]
        if i % 3 == 0:
            at = rnd.randrange(len(w) + 1)
            w[at:at] = passage[rnd.randrange(4):30 - rnd.randrange(4)]
        if i % 7 == 0 and rows:
            w = (rows[-1][1] or "").split() + w[:3]
        if i % 11 == 0:
            w = ["x"] * 40 + w
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(w)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed) + [(None, None), (None, "q w"), (3, corpus(seed)[0][1]), (900, None), (901, ""), (902, " \n ")]
    rows += [(5, rows[4][1])] * 2  # repeated rows
    df = spark.createDataFrame([(a, b, a, "x") for a, b in rows], "doc_id long, text string, _id long, anchor string").repartition(3)
    got = substring_dedup(df, window=12, anchor=4)
    assert got.columns == ["doc_id", "n_words", "n_removed", "spans", "kept_text"]
    assert result(got) == sorted(brute(rows, 12), key=str)


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query_on_the_whole_small_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(rows, 50))
    got = sorted(tuple(r) for r in QUERIES["op1_substring_dedup"](spark, d).collect())
    assert got == want and any(g[2] for g in got)


def test_words_that_differ_only_for_a_good_hash(spark):
    from test_symbols import thue_morse

    one, two = thue_morse(1024)
    rows = [(i, " ".join([w] + [f"w{k}" for k in range(49)])) for i, w in enumerate((one, two, one))]
    rows += [(10 + i, " ".join([w] * 12)) for i, w in enumerate((one, two))]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == sorted(brute(rows, 50), key=str)
    assert {r[0]: r[2] for r in result(got)} == {0: 0, 1: 0, 2: 50, 10: 0, 11: 0}


def test_every_long_is_an_id(spark):
    top = (1 << 63) - 1
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(top, text), (None, text), (-5, text + " x"), (top, None), (None, None), (None, "a b")]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), window=12, anchor=4)
    assert result(got) == sorted(brute(rows, 12), key=str)
    assert sorted((str(r[0]), r[1], r[2]) for r in result(got)) == sorted(
        [(str(top), 20, 20), ("None", 20, 20), ("-5", 21, 0), (str(top), 0, 0), ("None", 0, 0), ("None", 2, 0)])
