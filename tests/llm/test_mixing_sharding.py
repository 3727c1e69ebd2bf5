import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm.catalog import QUERIES
from llm.mixing import mix
import llm.sharding as sharding
from llm.sharding import document_dims, hilbert_index, shard, write_shards
from tools.compare import compare

SCHEMA = "doc_id long, text string, source string, size string, target string, lang string"


def targets(sizes):
    """The contract's rule, step by step. sizes: {source: words}."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    total = 1.5 * sum(sizes.values())
    while open_:
        left = total - sum(out.values())
        t = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if t[s] >= 2 * sizes[s]]
        if not over:
            out.update(t)
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.discard(s)
    return out


def rows(seed):
    rnd = random.Random(seed)
    out = [(i, " ".join(["w"] * rnd.randrange(0, 30)), rnd.choice(["a", "a", "a", "b", "é", "z", None]), "s", "t", "en") for i in range(300)]
    return out + [(None, None, "a", "s", "t", None), (7, "x y", "a", "", "", ""), (7, "x y", "a", "", "", ""), (8, "", "empty", "", "", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_targets(spark, seed):
    data = rows(seed)
    a = mix(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    b = mix(spark.createDataFrame(data, SCHEMA).repartition(2)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(a, key=key) == sorted(b, key=key) and len(a) == len(data)
    sizes, taken = {}, {}
    for r in a:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets(sizes)
    for r in a:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
    for s in sizes:
        assert 0 <= want[s] - taken[s] < 1 + 1e-6
    assert sum(0 < r.taken % r.size for r in a if r.size) <= len(sizes)  # one cut document a source


def test_mix_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", keys=["op9_source_mixing"], verbose=False)["op9_source_mixing"][0] == "OK"


def test_hilbert_curve_visits_neighbours(spark):
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        df = spark.range(side ** dims).select(*[(F.floor(F.col("id") / side ** k) % side).cast("int").alias(f"x{k}") for k in range(dims)])
        cells = {r[-1]: tuple(r[:-1]) for r in df.select("*", hilbert_index([F.col(f"x{k}") for k in range(dims)], bits)).collect()}
        path = [cells[i] for i in range(side ** dims)]
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_shards_are_even_and_gapless(spark):
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    out = shard(df, {"s": F.length("source"), "t": F.length("text")}, shards=7).collect()
    assert len(out) == len(data)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    assert set(by) == set(range(7)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = []
    for s in sorted(by):
        run = sorted(by[s], key=lambda r: r.slot)
        assert [r.slot for r in run] == list(range(len(run)))
        order += [r.curve for r in run]
    assert order == sorted(order)  # shards are runs of the curve
    texts = sorted((zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for _, t, *_ in data)
    assert sorted((r.text_crc32, r.size) for r in out) == texts


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).collect() == [] and shard(empty, {"s": F.length("source")}).collect() == []


def test_registered_sharding_on_the_whole_small_table(spark):
    d = "/root/testdata/sf0.001"
    out = QUERIES["op8_hilbert_sharding"](spark, d)
    assert not any(w in out._jdf.queryExecution().toString() for w in ("ArrowEval", "PythonUDF", "MapInArrow"))
    got = {r.doc_id: r for r in out.collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        assert (got[r.doc_id].size, got[r.doc_id].text_crc32) == (len(r.text.encode()) + 8, zlib.crc32(r.text.encode()))


def curve(point, bits):
    """Hilbert index from the definition: one quadrant (octant) after the other, with the
    reflections and rotations of the Gray code undone from the highest bit down."""
    x, n = list(point), len(point)
    for b in range(bits - 1, 0, -1):
        q = 1 << b
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for b in range(bits - 1, 0, -1):
        if x[n - 1] >> b & 1:
            t ^= (1 << b) - 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def brute_shards(rows, shards):
    """rows: (id, text, source, lang): the whole of the registered query."""
    placed = []
    for i, text, source, lang in rows:
        raw = (text or "").encode()
        name = lambda v: 0 if v is None else zlib.crc32(v.encode()) % 16
        cell = curve([name(source), name(lang), min(15, int(math.log2(len(raw) + 1) * 16 / 24))], 4)
        crc = zlib.crc32(raw)
        key = hashlib.md5(f"{'' if i is None else i}:{crc}".encode()).hexdigest()
        placed.append((cell, key, i is not None, i or 0, crc, len(raw) + 8))
    placed.sort()
    n, out = len(placed), []
    for at, (_, _, known, i, crc, size) in enumerate(placed):
        s = at * shards // n
        out.append((i if known else None, size, crc, s, at - -(-s * n // shards)))
    return sorted(out, key=str)


def got_shards(placed):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in placed.collect()), key=str)


@pytest.mark.parametrize("bucket_rows", [1, 100_000])
def test_whole_placement_against_brute_force(spark, monkeypatch, bucket_rows):
    """On the given table, with nulls and repeated rows; the order does not depend on the buckets."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", "lang")
    more = [(None, "no id", "a", "en")] * 3 + [(None, None, None, None), (7, "x", "a", None), (7, "x", "a", None), (8, "", None, "é")]
    docs = docs.union(spark.createDataFrame(more, docs.schema)).repartition(5)
    rows = [tuple(r) for r in docs.collect()]
    assert got_shards(shard(docs, document_dims(docs))) == brute_shards(rows, 24)


def test_registered_sharding_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source", "lang").collect()]
    out = QUERIES["op8_hilbert_sharding"](spark, d)
    assert got_shards(out) == brute_shards(rows, 24)
    assert {(r.law, r.grown_shard) for r in out.collect()} == {("rows", None)}


def test_written_shards_are_ordered_and_prunable(spark, tmp_path):
    """A reader that wants one value of a dimension needs a few shards only."""
    side = 16
    grid = spark.range(side * side * 8).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % side).cast("int").alias("x"),
                                               (F.floor(F.col("id") / side) % side).cast("int").alias("y"))
    placed = shard(grid, {"x": F.col("x"), "y": F.col("y")}, shards=16)
    write_shards(placed, str(tmp_path / "shards"), files=6)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert got_shards(back) == got_shards(placed)
    whole = back.join(grid.select("doc_id", "x", "y"), "doc_id")
    touched = {c: [r["n"] for r in whole.groupBy(c).agg(F.count_distinct("shard").alias("n")).collect()] for c in "xy"}
    assert all(max(n) <= 4 for n in touched.values())  # of 16 shards, for every value of either dimension
    for part in (tmp_path / "shards").glob("shard=*/*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(part)).collect()]
        assert slots == sorted(slots)
