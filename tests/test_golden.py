"""Golden values of the tiny fixture (FIXTURES.md section 3)."""

import pytest

from kinship import mae, predict, preprocess, similarity, user_avg, global_avg
from kinship.operators.features import pair_count
from kinship.operators.recommend import recommend
from kinship.operators.similarity import co_ratings
from kinship.operators.skew import SkewPolicy
from kinship.operators.stats import multiplications_total, nonzero_bytes, summary_with_zeros

ORDER = [(1, 40), (2, 30), (3, 10), (4, 40), (5, 10), (6, 20), (1, 99), (9, 10), (9, 99), (5, 60)]

EXPECTED = {
    ("cosine", 0): [5, 2.217908, 2.239626, 3, 5, 3.16171, 3, 3.125, 3.125, 3],
    ("cosine", 1): [5, 1, 1, 3, 3, 5, 3, 3.125, 3.125, 3],
    ("cosine", 3): [5, 1, 1, 3, 3, 4.621595, 3, 3.125, 3.125, 3],
    ("cosine", 5): [5, 2.217908, 2.239626, 3, 5, 3.16171, 3, 3.125, 3.125, 3],
    ("jaccard", 0): [3, 3.444444, 3.821839, 3.909091, 1, 2.818841, 3, 3.125, 3.125, 3],
    ("jaccard", 1): [3, 3.666667, 5, 3, 1, 2.666667, 3, 3.125, 3.125, 3],
    ("jaccard", 3): [3, 2.866667, 4.166667, 3.909091, 1, 2.666667, 3, 3.125, 3.125, 3],
    ("jaccard", 5): [3, 3.444444, 3.821839, 3.909091, 1, 2.818841, 3, 3.125, 3.125, 3],
}
EXPECTED_MAE = {
    ("cosine", 0): 0.506657, ("cosine", 1): 0.925, ("cosine", 3): 0.887159, ("cosine", 5): 0.506657,
    ("jaccard", 0): 1.160653, ("jaccard", 1): 1.225, ("jaccard", 3): 1.152576, ("jaccard", 5): 1.160653,
}


@pytest.mark.parametrize("metric,k", sorted(EXPECTED))
def test_predictions(tiny, metric, k):
    train, targets = tiny
    pred = predict(train, targets, metric, k)
    got = {(r.user, r.item): r.prediction for r in pred.collect()}
    assert len(got) == len(ORDER)
    for (u, i), want in zip(ORDER, EXPECTED[(metric, k)]):
        assert got[(u, i)] == pytest.approx(want, abs=5e-7), (u, i)
    assert mae(pred).first()["mae"] == pytest.approx(EXPECTED_MAE[(metric, k)], abs=5e-7)


@pytest.mark.parametrize("metric,k", [("cosine", 0), ("cosine", 3), ("jaccard", 1)])
def test_salting_does_not_change_results(tiny, metric, k):
    train, targets = tiny
    plain = {(r.user, r.item): r.prediction for r in predict(train, targets, metric, k).collect()}
    salted = predict(train, targets, metric, k, skew=SkewPolicy(bucket_rows=1))
    for r in salted.collect():
        assert r.prediction == pytest.approx(plain[(r.user, r.item)], abs=1e-12)


def test_means(tiny):
    train, _ = tiny
    means = {r.user: r.avg_rating for r in user_avg(train).collect()}
    want = {1: 3, 2: 3.666667, 3: 3.333333, 4: 3, 5: 3, 6: 2.666667}
    assert means == pytest.approx(want, abs=5e-7)
    assert global_avg(train).first()["global_avg"] == pytest.approx(3.125)


SIMS = {
    (2, 1): (0.146647, 0.5), (3, 1): (-0.19245, 0.5), (3, 2): (-0.917223, 0.5),
    (4, 1): (0, 0.666667), (4, 2): (0, 0.666667), (4, 3): (0, 0.25),
    (6, 1): (-0.96225, 0.5), (6, 2): (-0.141111, 0.2), (6, 3): (0.185185, 0.2),
    (6, 4): (0, 0.25), (6, 5): (-0.19245, 0.25),
}


@pytest.mark.parametrize("metric,col", [("cosine", 0), ("jaccard", 1)])
def test_similarities(tiny, metric, col):
    train, _ = tiny
    got = {(r.user, r.neighbour): r.sim for r in similarity(preprocess(train), metric).collect()}
    want = {p: v[col] for p, v in SIMS.items() if v[col] != 0}
    assert set(got) == set(want)
    for p, v in want.items():
        assert got[p] == pytest.approx(v, abs=5e-7)


def test_pair_statistics(tiny):
    train, _ = tiny
    pre = preprocess(train)
    n_pairs = pair_count(train).select("n_pairs").scalar()
    assert pair_count(train).first()["n_pairs"] == 15
    ov = summary_with_zeros(co_ratings(pre), "overlap", n_pairs).first()
    assert (ov.min_value, ov.max_value) == (0, 2)
    assert ov.mean_value == pytest.approx(1.133333, abs=5e-7)
    assert ov.stddev_value == pytest.approx(0.805536, abs=5e-7)
    assert multiplications_total(train).first()["multiplications"] == 17
    assert tuple(nonzero_bytes(similarity(pre, "cosine")).first()) == (7, 56)
    assert tuple(nonzero_bytes(similarity(pre, "jaccard")).first()) == (11, 88)
    cos = summary_with_zeros(similarity(pre, "cosine"), "sim", n_pairs).first()
    assert [cos.min_value, cos.max_value, cos.mean_value, cos.stddev_value] == pytest.approx(
        [-0.96225, 0.185185, -0.138244, 0.329681], abs=5e-7)
    jac = summary_with_zeros(similarity(pre, "jaccard"), "sim", n_pairs).first()
    assert [jac.min_value, jac.max_value, jac.mean_value, jac.stddev_value] == pytest.approx(
        [0, 0.666667, 0.298889, 0.233291], abs=5e-7)


@pytest.mark.parametrize("k,want", [
    (2, [(40, 5.0), (50, 3.0), (60, 3.0), (20, 2.840135)]),
    (6, [(40, 5.0), (50, 3.8), (60, 3.0), (20, 2.575678)]),
])
def test_recommender(spark, tiny, k, want):
    train, _ = tiny
    titles = dict(zip([10, 20, 30, 40, 50, 60], "ABCDEF"))
    rated = {10: 5.0, 30: 1.0}
    personal = spark.createDataFrame(
        [(i, t, rated.get(i)) for i, t in titles.items()], "item long, title string, rating double")
    rows = recommend(train, personal, k, n=5, user=7).collect()
    assert [(r.item, r.prediction) for r in rows] == [(i, pytest.approx(p, abs=5e-7)) for i, p in want]
    assert [r.title for r in rows] == [titles[i] for i, _ in want]
