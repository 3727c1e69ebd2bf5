"""An independent, naive dense implementation (pure Python over all user
pairs, test code only) against the Spark operators on sf0.001."""

import math

import duckdb
import pytest

from tiny_data import SF_SMALL
from kinship import predict
from kinship.sources.tables import ratings_from_orders, split_ratings


def _load():
    con = duckdb.connect()
    rows = con.execute(f"""
        SELECT o_custkey, l_partkey, CAST(max(1 + CAST(floor((l_quantity - 1) / 10) AS INTEGER)) AS DOUBLE)
        FROM read_parquet('{SF_SMALL}/orders.parquet') JOIN read_parquet('{SF_SMALL}/lineitem.parquet')
          ON o_orderkey = l_orderkey GROUP BY 1, 2""").fetchall()
    train = [r for r in rows if (r[0] * 7 + r[1] * 13) % 5 != 0]
    test = [r for r in rows if (r[0] * 7 + r[1] * 13) % 5 == 0]
    return train, test


def _scale(x, a):
    return 5.0 - a if x > a else (a - 1.0 if x < a else 1.0)


def dense_predictions(train, test, metric, k):
    by_user = {}
    for u, i, r in train:
        by_user.setdefault(u, {})[i] = r
    avg = {u: sum(v.values()) / len(v) for u, v in by_user.items()}
    g = sum(r for _, _, r in train) / len(train)
    dev = {u: {i: (r - avg[u]) / _scale(r, avg[u]) for i, r in v.items()} for u, v in by_user.items()}
    norm = {u: math.sqrt(sum(d * d for d in v.values())) for u, v in dev.items()}
    ndev = {u: {i: (d / norm[u] if norm[u] else 0.0) for i, d in v.items()} for u, v in dev.items()}
    users = sorted(by_user)

    def sim(u, v):
        common = by_user[u].keys() & by_user[v].keys()
        if metric == "cosine":
            s = sum(ndev[u][i] * ndev[v][i] for i in common)
        else:
            s = len(common) / (len(by_user[u]) + len(by_user[v]) - len(common))
        return round(s, 12) + 0.0

    sims = {}
    for a in users:
        for b in users:
            if a < b:
                sims[(a, b)] = sims[(b, a)] = sim(a, b)
    nbrs = {}
    for u in users:
        others = [(v, sims[(u, v)]) for v in users if v != u]
        if k > 0:
            others = sorted(others, key=lambda t: (-t[1], t[0]))[:k]
        nbrs[u] = dict(others)
    out = {}
    for u, i, _ in test:
        if u not in avg:
            out[(u, i)] = g
            continue
        num = den = 0.0
        for v, s in nbrs[u].items():
            if i in dev[v]:
                num += dev[v][i] * s
                den += abs(s)
        w = num / den if den else 0.0
        out[(u, i)] = avg[u] + w * _scale(avg[u] + w, avg[u])
    return out


@pytest.fixture(scope="module")
def data():
    return _load()


@pytest.mark.parametrize("metric,k", [("cosine", 0), ("cosine", 10), ("cosine", 100), ("jaccard", 0), ("jaccard", 50)])
def test_against_dense(spark, data, metric, k):
    train, test = data
    want = dense_predictions(train, test, metric, k)
    s_train, s_test = split_ratings(ratings_from_orders(spark, SF_SMALL))
    got = {(r.user, r.item): r.prediction for r in predict(s_train, s_test, metric, k).collect()}
    assert got.keys() == want.keys()
    worst = max(abs(got[key] - want[key]) for key in want)
    assert worst < 1e-9
