import random
import re

import pytest

from llm.decontaminate import contained_items, decontaminate
from tools.compare import compare

DOCS, ITEMS = "doc_id long, text string, item_id long", "item_id long, text string, doc_id long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(w))
    return n, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set(), w


def brute(docs, items):
    out = []
    for d, t in docs:
        _, _, w = shingles(t)
        for i, it in items:
            n, own, _ = shingles(it)
            if i is not None and own:
                have = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
                if 10 * len(own & have) >= 8 * len(own):
                    out.append((d, i, len(own), len(own & have)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 10 ** 6])
def test_matches_brute_force(spark, block):
    rnd = random.Random(4)
    text = lambda n: [rnd.choice("abcdefgh") + rnd.choice("xyzÉ") for _ in range(n)]
    items = [(i, text(rnd.choice([1, 2, 3, 4, 5, 6, 30, 80]))) for i in range(30)]
    docs = []
    for i in range(120):
        w = text(rnd.randrange(0, 150))
        if i % 2:
            own = list(rnd.choice(items)[1])
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(len(own))] = "new"
            w[len(w) // 2:len(w) // 2] = [x.upper() if i % 3 else x for x in own]
        docs.append((i, rnd.choice([" ", "\n"]).join(w)))
    docs += [(900, None), (901, ""), (None, docs[1][1]), (902, "q " * 40000 + " ".join(items[6][1])), docs[3]]
    items = [(i, " ".join(w)) for i, w in items] + [(90, None), (91, " "), (None, "a b c"), (92, " ".join(items[6][1]))]
    d = spark.createDataFrame([(*r, 0) for r in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(*r, 0) for r in items], ITEMS)
    got = contained_items(d, b, block_shingles=block)
    assert sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got.collect()), key=str) == brute(docs, items)
    bad = {r[0] for r in brute(docs, items)}
    kept = decontaminate(d, b, block_shingles=block)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in docs if r[0] not in bad), key=str)


def test_items_without_an_id_remove_documents(spark):
    d = spark.createDataFrame([(1, "x a b c d e f y", 0), (2, "a b c", 0), (3, "k l m n o p", 0)], DOCS)
    b = spark.createDataFrame([(None, "a B c d e f", 0), (7, "k l m n o", 0), (None, None, 0)], ITEMS)
    assert [r.doc_id for r in decontaminate(d, b).collect()] == [2]
    assert [(r.doc_id, r.item_id) for r in contained_items(d, b).collect()] == [(3, 7)]


def test_a_large_benchmark_stays_out_of_the_driver(spark, monkeypatch):
    def refuse(*args):
        raise AssertionError("an index on the driver")

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    d = spark.createDataFrame([(i, f"the {text(i)} end", 0) for i in range(50)] + [(None, text(3), 0)], DOCS).repartition(3)
    b = spark.createDataFrame([(i, text(i), 0) for i in range(0, 50, 2)] + [(7, text(3), 0)], ITEMS)
    want = sorted((tuple(r) for r in contained_items(d, b).collect()), key=str)
    assert len(want) == 27
    monkeypatch.setattr("llm.decontaminate._Index", refuse)
    joined = contained_items(d, b, block_shingles=100)
    assert joined.columns == ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"]
    assert sorted((tuple(r) for r in joined.collect()), key=str) == want


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b c d e", 0)], DOCS), spark.createDataFrame([(1, "a b c d e", 0)], ITEMS)
    assert contained_items(d.limit(0), b).collect() == [] and contained_items(d, b.limit(0)).collect() == []
    assert decontaminate(d, b.limit(0)).count() == 1 and decontaminate(d, b).count() == 0


def test_matches_sql_on_the_whole_small_table(spark):
    got = compare(spark, "/root/testdata/sf0.001", keys=["op10_benchmark_decontamination"], verbose=False)
    assert got["op10_benchmark_decontamination"][0] == "OK"


@pytest.mark.parametrize("most", [0, 10**6])
def test_words_that_differ_only_for_a_good_hash(spark, most):
    from test_symbols import thue_morse

    one, two = thue_morse(1024)
    items = spark.createDataFrame([(1, one), (2, f"{one} a b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {two} a b c d y"), (2, f"x {one} a b c d y")], "doc_id long, text string")
    found = contained_items(docs, items, block_shingles=most).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(2, 1), (2, 2)]
