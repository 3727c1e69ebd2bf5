"""Merkle manifest against a tree built leaf by leaf."""

import hashlib
import zlib
from collections import defaultdict

import pytest

import llm.merkle as merkle
from llm.merkle import levels, merkle_proofs, ranked_leaves, tampered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(root, path of every node): a path is a list of (siblings before, siblings after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i // 2 * 2:i // 2 * 2 + 2]
            paths[leaf].append((run[:i % 2], run[i % 2 + 1:]))
        at = [i // 2 for i in at]
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows):
    by_lang = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = lambda n: H(*map(field, (doc_id, source, lang, n, text)))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        by_lang[lang].append(((doc_id is not None, doc_id or 0), leaf(n_chars), leaf(n_chars + 1 if bad else n_chars), doc_id))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: climb([r[1] for r in sorted(by_lang[lang], key=lambda r: r[:2])]) for lang in langs}
    root, tops = climb([trees[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, paths = trees[lang]
        for (_, leaf, claim, doc_id), path in zip(sorted(by_lang[lang], key=lambda r: r[:2]), paths):
            end = claim
            for before, after in path + top:
                end = H(*before, end, *after)
            out.append((doc_id, leaf, subroot, root, H(*[s for b, a in path + top for s in (*b, *a)]), end, end == root))
    return sorted(out, key=str)


def rows_of(n):
    langs = ["en"] * 5 + ["fr", "fr", None, "zh", "é"]
    rows = [(i, f"text {i} é" if i % 11 else None, langs[i % 10], None if i % 13 == 0 else f"s{i % 3}", None if i % 17 == 0 else i) for i in range(n)]
    rows += [(3, "", "en", "", 0)] * 4 + [(None, "no id", "en", "s", 1), (None, None, None, None, None), (5, "lone", "xx", "s", 2)]
    return rows


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("band", [1, 2, 3, 10])
def test_proofs_match_a_tree_built_leaf_by_leaf(spark, monkeypatch, band):
    """Also with bands so low that a small tree has several."""
    monkeypatch.setattr(merkle, "BAND", band)
    rows = rows_of(90)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(merkle_proofs(docs, claims=tampered(docs))) == brute(rows)


def test_larger_trees_with_one_language_in_most_rows(spark):
    rows = rows_of(2600)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    proofs = merkle_proofs(docs, claims=tampered(docs))
    out = got(proofs)
    assert out == brute(rows)
    assert 0 < sum(not r[-1] for r in out) < len(out)


def test_single_leaf_empty_table_and_clashing_columns(spark):
    one = [(1, "a", "en", "s", 1)]
    docs = spark.createDataFrame(one, SCHEMA)
    assert got(merkle_proofs(docs, claims=tampered(docs))) == brute(one)
    none = spark.createDataFrame([], SCHEMA)
    assert merkle_proofs(none).collect() == []
    rows = rows_of(30)
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "claim", "idx", "tree", "n", "part", "nr", "_salt", "digest", "bucket", "root", "path"):
        docs = docs.selectExpr("*", f"doc_id as {name}")
    assert got(merkle_proofs(docs, claims=tampered(docs))) == brute(rows)


def test_largest_count_has_a_successor_and_ranks_are_gapless(spark):
    top = [((next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 0)), "a", "en", "s", (1 << 63) - 1), (1 << 62, "b", "en", "s", 1)]
    docs = spark.createDataFrame(top, SCHEMA)
    assert got(merkle_proofs(docs, claims=tampered(docs))) == brute(top)
    many = spark.range(5000).selectExpr("if(id % 3 = 0, 'x', 'y') lang", "id % 7 doc_id", "cast('same' as binary) leaf").repartition(9)
    ranks = ranked_leaves(many).collect()
    for lang in "xy":
        assert sorted(r["idx"] for r in ranks if r["lang"] == lang) == list(range(sum(r["lang"] == lang for r in ranks)))
    assert [levels(n) for n in (0, 1, 2, 3, 4, 5, 1024, 1025)] == [0, 0, 1, 2, 2, 3, 10, 11]
