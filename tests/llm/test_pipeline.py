"""Every stage of the pipeline against brute force, on its own input."""

import collections
import hashlib
import re
import zlib

from pyspark.sql import functions as F

import corpus_pipeline as pipe
from kinship.session import write_table

from test_decontaminate import brute as contained
from test_jaccard_join import shingles
from test_mixing_sharding import targets

SF = "/root/testdata/sf0.001"


def groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                c = len(sets[x] & sets[y])
                if 100 * c >= percent * (len(sets[x]) + len(sets[y]) - c):
                    a, b = sorted((find(x), find(y)))
                    parent[b] = a
    return {i: find(i) for i in ids}


def copies(rows):
    """rows: (id, text, source); how often each id is taken."""
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    by = collections.defaultdict(list)
    for i, _, s in rows:
        by[s].append((hashlib.md5(f"mix-1:{i}".encode()).hexdigest(), i))
    want = targets({s: sum(words[i] for _, i in own) for s, own in by.items()})
    out = {}
    for s, own in by.items():
        size = sum(words[i] for _, i in own)
        epochs, left = (int(want[s] // size), int(want[s] - want[s] // size * size)) if size else (0, 0)
        for _, i in sorted(own):
            out[i] = (epochs + (left > 0) if words[i] else 0)
            left -= words[i]
    return {i: c for i, c in out.items() if c}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", None, 0), (9002, "12 34 --", None, "src0", 8), (9003, "", "en", "src1", 0)], docs.schema)
    docs = write_table(docs.union(extra), "pipeline-test")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}

    def after(name, frame):
        out = write_table(pipe.STAGES[name][1](spark, frame, SF), "pipeline-test")
        return out, [r.doc_id for r in out.collect()]

    docs, ids = after(0, docs)
    want = {i for i, r in rows.items() if r.text and re.search(r"[^\W\d_]", r.text)}
    assert docs.columns == columns and sorted(ids) == sorted(want) and 9001 not in want

    docs, ids = after(1, docs)
    part = groups([(i, rows[i].text) for i in want], 5, 80)
    want = {i for i, g in part.items() if i == g}
    assert docs.columns == columns and sorted(ids) == sorted(want)

    docs, ids = after(2, docs)
    bad = {r[0] for r in contained([(i, rows[i].text) for i in want], items)}
    want -= bad
    assert bad and docs.columns == columns and sorted(ids) == sorted(want)

    docs, ids = after(3, docs)
    count = copies([(i, rows[i].text, rows[i].source) for i in sorted(want)])
    assert docs.columns == columns and collections.Counter(ids) == count and max(count.values()) == 2

    last, _ = after(4, docs)
    out = last.collect()
    assert collections.Counter(r.doc_id for r in out) == count
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.text_crc32 == zlib.crc32(rows[r.doc_id].text.encode())
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 24
    assert [n for n, _ in pipe.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_language_stage_without_labels_and_with_clashing_columns(spark):
    rows = [(1, "some words", None, 0.5, "a", 1), (2, None, None, 1.0, "b", 2), (3, "12 -- 34", None, 2.0, "c", 3), (4, "ß 1", None, 3.0, None, 4), (5, "", None, 4.0, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, _score int")
    out = pipe.language_stage(spark, docs, SF)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == [rows[0], rows[3]]
    named = docs.withColumn("lang", F.lit("und"))  # a label like any other
    assert sorted(r.doc_id for r in pipe.language_stage(spark, named, SF).collect()) == [1, 4]


def test_run_and_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipe.run(spark, str(tmp_path)).collect() == []


WORDS = {"en": "the quick and of that with", "de": "der schnelle und nicht eine über", "es": "el rápido y los niños años", "xx": "zqx kvv wjj"}


def test_language_stage_keeps_the_stated_languages(spark):
    rows = [(i, " ".join([WORDS[k]] * (1 + i % 7)), k) for i in range(60) for k in WORDS]
    rows += [(500, WORDS["xx"], None), (501, WORDS["xx"], "en"), (502, WORDS["de"], None), (503, "12 - 3", "en"), (504, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {(r.doc_id, r.text) for r in pipe.language_stage(spark, docs, SF).collect()}
    assert kept == {(i, t) for i, t, _ in rows if t and t.split()[0] in ("the", "der", "el")}
    german = pipe.language_stage(spark, docs, SF, keep=("de",)).collect()
    assert {(r.doc_id, r.text) for r in german} == {(i, t) for i, t, _ in rows if t and t.startswith("der")}


INSIDE = ("row", "id", "mark", "rid", "rv", "_rid", "_rv", "_mark", "_copies", "_copy", "copies", "copy", "plan_id", "plan_mark", "stay_id", "stay_v",
          "body", "item", "size", "taken", "target", "_key", "_bucket", "curve", "_id", "_v", "_text", "lang_pred", "score", "a.b")


def test_stages_keep_columns_of_every_name(spark):
    """Every name that a stage uses inside, as an extra column."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = write_table(docs.select("*", *[F.concat(F.lit(f"{n}:"), docs["doc_id"].cast("string")).alias(n) for n in INSIDE]), "pipeline-test")
    plain = write_table(docs.select("doc_id", "text", "lang", "source", "n_chars"), "pipeline-test")
    for name, stage in pipe.STAGES[:-1]:
        docs, plain = (write_table(stage(spark, d, SF), "pipeline-test") for d in (docs, plain))
        got = docs.collect()
        assert set(INSIDE) < set(docs.columns), name
        assert all(r[n] == f"{n}:{r.doc_id}" for r in got for n in INSIDE), name
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain.collect()), name
    last = pipe.STAGES[-1][1]
    assert sorted(map(tuple, last(spark, docs, SF).collect())) == sorted(map(tuple, last(spark, plain, SF).collect()))


def test_nulls_and_repeated_rows_in_every_stage(spark):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 2), (3, None, None, None, None), (None, "lone words", "en", None, 3),
            (None, None, None, None, None), (4, "", "en", "s", 4), (4, "", "en", "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    ids = lambda frame: sorted((r.doc_id for r in frame.collect()), key=str)
    assert ids(pipe.near_duplicate_stage(spark, docs, SF)) == sorted([1, 3, None, None, 4], key=str)
    assert ids(pipe.decontamination_stage(spark, docs, SF)) == sorted([r[0] for r in rows], key=str)
    mixed = collections.Counter(ids(pipe.mixing_stage(spark, docs, SF)))
    assert set(mixed) <= {1, 2, None} and all(c <= 4 for c in mixed.values())
    assert len(pipe.sharding_stage(spark, docs, SF).collect()) == len(rows)
