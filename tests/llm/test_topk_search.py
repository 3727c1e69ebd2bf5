import math
import random

import pytest
from pyspark.sql import functions as F

from llm.topk_search import top_k
from tools.compare import compare

SCHEMA = "vec_id long, embedding array<float>, id long, score string"


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 10 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("pivots,blocks", [(4, (7, 11)), (1, (100, 1000)), (32, (3, 50))])
def test_matches_brute_force(spark, pivots, blocks):
    rnd = random.Random(pivots)
    unit = lambda: [rnd.randrange(-1024, 1025) / 1024 for _ in range(6)]
    same = unit()
    rows = [(i, same if i % 4 == 0 else unit()) for i in range(200)]
    rows += [(None, unit()), (1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1003, [float("inf")] + [0.0] * 5),
             (1010, [0.5, 0.25]), (1011, [0.5, 1.0]), (1020, []), (7, rows[7][1])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], SCHEMA).repartition(4)
    got = top_k(df, F.col("vec_id") % 10 == 0, k=5, pivots=pivots, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0], 1, ""), (1, [2.0], 1, "")], SCHEMA)
    assert [tuple(r) for r in top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_matches_sql_on_the_whole_small_table(spark):
    got = compare(spark, "/root/testdata/sf0.001", keys=["op6_pivot_topk"], verbose=False)
    assert got["op6_pivot_topk"][0] == "OK"


def test_large_finite_components(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.choice([1e30, -1e30, 3.0, 2.0 ** 40, 1e13, 0.1]) for _ in range(4)]) for i in range(60)]
    rows += [(100, [1e306, 0.0, 0.0, 0.0]), (110, [2.0 ** 53, 1.0, 0.0, 0.0]), (111, [2.0 ** -10, -1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, k=7, pivots=5, query_block=100, candidate_block=1000).collect())
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    want = []
    whole = [(i, [int(x) * 1024 if abs(x) >= 2 ** 53 else math.floor(1024 * x) for x in v]) for i, v in rows if i != 100]  # 1024e306 is no double
    for i, q in whole:
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i)[:7]
            want.append([i, [(j, clip(-s)) for s, j in best]])
    assert len(got) == 7 * len(want)
    for i, best in want:
        mine = [(j, s) for q, _, j, s in got if q == i]
        assert [s for _, s in mine] == [s for _, s in best]
        assert {(j, s) for j, s in mine if abs(s) < 2 ** 62} == {(j, s) for j, s in best if abs(s) < 2 ** 62}
