"""Properties on the sf0.001 tables: invariances, ranges, consistency of paths."""

import pytest
from pyspark.sql import functions as F

from tiny_data import SF_SMALL
from kinship import directed, predict, preprocess, similarity
from kinship.operators.features import user_count
from kinship.operators.skew import SkewPolicy
from kinship.sources.tables import ratings_from_orders, split_ratings


@pytest.fixture(scope="module")
def small(spark):
    train, targets = split_ratings(ratings_from_orders(spark, SF_SMALL))
    return train.cache(), targets.cache()


def _preds(df):
    return {(r.user, r.item): r.prediction for r in df.collect()}


def test_one_prediction_per_target_in_range(small):
    train, targets = small
    for metric in ("cosine", "jaccard"):
        rows = predict(train, targets, metric, 0).collect()
        assert len(rows) == targets.count()
        assert len({(r.user, r.item) for r in rows}) == len(rows)
        assert all(1.0 - 1e-9 <= r.prediction <= 5.0 + 1e-9 for r in rows)


def test_similarity_ranges(small):
    train, _ = small
    pre = preprocess(train)
    cos = similarity(pre, "cosine").agg(F.min("sim"), F.max("sim")).first()
    jac = similarity(pre, "jaccard").agg(F.min("sim"), F.max("sim")).first()
    assert -1.0 <= cos[0] <= cos[1] <= 1.0
    assert 0.0 < jac[0] <= jac[1] <= 1.0


def test_target_user_pairs_match_triangle(small):
    train, targets = small
    pre = preprocess(train)
    tri = {(r.user, r.neighbour): r.sim for r in directed(similarity(pre, "cosine")).collect()}
    users = targets.select("user").distinct()
    some = {(r.user, r.neighbour): r.sim for r in similarity(pre, "cosine", for_users=users).collect()}
    target_users = {r.user for r in users.collect()}
    assert some == {p: s for p, s in tri.items() if p[0] in target_users}


def test_k_at_least_n_minus_1_equals_all(small):
    train, targets = small
    n = user_count(train).first()["n_users"]
    for metric in ("cosine", "jaccard"):
        a = _preds(predict(train, targets, metric, 0))
        b = _preds(predict(train, targets, metric, n - 1))
        assert a.keys() == b.keys()
        assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_partitioning_and_salting_do_not_matter(small):
    train, targets = small
    base = _preds(predict(train, targets, "cosine", 10))
    other = _preds(predict(train.repartition(7), targets.repartition(3), "cosine", 10,
                           skew=SkewPolicy(bucket_rows=5)))
    assert base.keys() == other.keys()
    assert all(abs(base[k] - other[k]) < 1e-9 for k in base)


def test_order_preserving_relabel(small):
    train, targets = small
    relabel = lambda df: df.select((F.col("user") * 3 + 1000).alias("user"), "item", "rating")
    a = _preds(predict(train, targets, "jaccard", 10))
    b = _preds(predict(relabel(train), relabel(targets), "jaccard", 10))
    assert {((u - 1000) // 3, i): p for (u, i), p in b.items()} == pytest.approx(a, abs=1e-9)


def test_salted_pairs_equal_plain_pairs(small):
    """Force every item with more than 5 raters through the salted self-join."""
    from kinship.operators.similarity import co_ratings
    from kinship.operators.skew import plan_join

    train, _ = small
    pre = preprocess(train)
    hot = plan_join(train, train, "item", SkewPolicy(bucket_rows=5))
    assert hot.buckets is not None and hot.buckets.count() > 10
    plain = {(r.user, r.neighbour): (r.overlap, r.dot) for r in co_ratings(pre).collect()}
    salted = {(r.user, r.neighbour): (r.overlap, r.dot) for r in co_ratings(pre, hot).collect()}
    assert plain.keys() == salted.keys()
    for key, (n, dot) in plain.items():
        assert salted[key][0] == n
        assert abs(salted[key][1] - dot) < 1e-12


def test_pairs_of_a_task_are_bounded_under_skew(spark):
    """One item rated by everyone and many just below the bucket size: no task emits
    more than a small multiple of its share, and the pairs are the plain ones."""
    from pyspark.sql import functions as F

    from kinship.operators.skew import plan_join, salted_join

    users, policy = 1200, SkewPolicy(bucket_rows=100, pairs_per_task=20_000)
    everyone = spark.range(users).select(F.col("id").alias("user"), F.lit(0).cast("long").alias("item"))
    below = spark.range(99 * 40).select((F.col("id") % 99).alias("user"), (F.col("id") % 40 + 1).alias("item"))
    rows = everyone.union(below)
    plan = plan_join(rows, rows, "item", policy)
    right = rows.withColumnRenamed("user", "neighbour")
    pairs = salted_join(rows, right, "item", plan, "user", "neighbour")
    total = users * users + 40 * 99 * 99
    per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == total == rows.join(right, "item").count()
    assert plan.partitions >= total // policy.pairs_per_task
    assert max(per_task) <= 6 * policy.pairs_per_task


def test_one_sided_skew_copies_the_small_side_only(spark):
    from pyspark.sql import functions as F

    from kinship.operators.skew import _A, _B, _cut, plan_join

    one = spark.createDataFrame([(7, 0)], "user long, item long")
    many = spark.range(1000).select(F.col("id").alias("neighbour"), F.lit(0).cast("long").alias("item"))
    plan = plan_join(one, many, "item", SkewPolicy(bucket_rows=50))
    assert _cut(one, "item", plan, "user", _A, _B, "_left", "_right").count() == 20
    assert _cut(many, "item", plan, "neighbour", _B, _A, "_right", "_left").count() == 1000


def test_pair_count_is_exact_for_many_users(spark):
    from kinship.operators.features import half_square

    n = [0, 1, 2, 3, 200_000_003, 300_000_003, 4_000_000_000]
    got = spark.createDataFrame([(x,) for x in n], "n long").select(half_square("n")).collect()
    assert [r[0] for r in got] == [x * (x - 1) // 2 for x in n]
