"""Ordered pairs sent as lists of raters: the pairs, ranks and candidates of the plain way, in fewer rows between tasks."""

import pytest
from pyspark.sql import functions as F

from test_listed import exchanges
from tiny_data import SCHEMA

from kinship.operators import predict as predict_mod
from kinship.operators.features import known_users, normalized_deviation, user_table
from kinship.operators.neighbors import directed, neighbors
from kinship.operators.packed import plane_value, planes
from kinship.operators.similarity import co_ratings, pair_input, similarity
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy, plan_join

SMALL = SkewPolicy(pairs_per_task=2_000)


@pytest.fixture(scope="module")
def rows(spark):
    """(train, targets) with wide and negative ids, unrated, repeated and ownerless rows."""
    every = spark.range(1_200).selectExpr(
        "(id % 60 - 7) * 10000019 as user", "(id * 7 + id div 60) % 40 as item", "cast((id * 3 + id div 40) % 5 + 1 as double) as rating")
    every = spark.createDataFrame(every.dropDuplicates(["user", "item"]).collect(), SCHEMA)
    odd = spark.createDataFrame([(3, 5, None), (2**62, 5, 4.0), (None, 5, 4.0), (-(2**63), 5, 1.0), (-(2**63), 6, 2.0), (2**62, 6, 1.0),
                                 (6, None, 2.0), (9, 11, 3.0), (9, 11, 3.0), (9, 5, 1.0)], SCHEMA)
    cold = spark.createDataFrame([(10**6, 5, 3.0), (9, 10**6, 2.0), (None, 5, 1.0), (9, None, 1.0)], SCHEMA)
    train = every.where("(user + 3 * item) % 5 <> 0").unionByName(odd).cache()
    return train, every.where("(user + 3 * item) % 5 = 0").unionByName(cold).cache()


def close(df):
    names = [c for c, t in df.dtypes if t != "double"]
    found = sorted(([r[c] for c in names], [r[c] for c in df.columns if c not in names]) for r in df.collect())
    return [(ids, [pytest.approx(v, abs=1e-9) for v in values]) for ids, values in found]


def same(one, other):
    return len(one) == len(other) > 0 and all(a[0] == b[0] and [v.expected for v in a[1]] == b[1] for a, b in zip(one, other))


def test_planes_give_back_any_long(spark):
    longs = [0, 1, -1, 255, 32768, 65535, 65536, 2**24, 2**31, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(ids,) for ids in (longs, longs[3:6], [2**20], [5])], "l array<long>")
    bits = F.aggregate("l", F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    split = df.withColumn("b", bits).select("l", *planes("l", "b", "v")).select("*", F.posexplode("v_low").alias("p", "_"))
    assert all(r.l[r.p] == r.got for r in split.withColumn("got", plane_value("v", "p")).collect())
    assert df.withColumn("b", bits).select(*planes("l", "b", "v")).where("v_top is null").count() == 3


@pytest.mark.parametrize("metric", [None, "cosine", "jaccard"])
@pytest.mark.parametrize("skew", [SMALL, SkewPolicy(pairs_per_task=300), SkewPolicy(bucket_rows=7, pairs_per_task=900)])
def test_lists_give_the_pairs_of_the_plain_way(spark, rows, metric, skew):
    train, _ = rows
    pre = pair_input(train, metric)
    plan = plan_join(train, train, "item", skew, deal="user")
    assert plan.partitions > 1
    cols = ["user", "neighbour", "overlap"] + (["dot"] if metric == "cosine" else [])
    assert same(close(co_ratings(pre, plan, ordered=True).select(*cols)), close(directed(co_ratings(pre)).select(*cols)))


@pytest.mark.parametrize("metric, k", [("cosine", 4), ("cosine", 58), ("jaccard", 20)])
@pytest.mark.parametrize("skew", [DEFAULT_SKEW, SkewPolicy(pairs_per_task=300), SkewPolicy(bucket_rows=7, pairs_per_task=5_000)])
def test_lists_give_the_ranked_candidates_of_the_plain_way(spark, rows, metric, k, skew):
    train, targets = rows
    users = user_table(train)
    ranked = neighbors(directed(similarity(pair_input(train, metric), metric)), k, known_users(users))
    want = predict_mod.ranked_candidates(targets, normalized_deviation(train, users=users), ranked)
    got = predict_mod.ranked_lists(train, targets, users, metric, k, predict_mod.DEFAULT_SCALE, skew, plan_join(targets, train, "item", skew))
    assert same(close(got), close(want.select(*got.columns)))


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_no_shuffle_holds_a_row_per_ordered_pair(spark, rows, metric):
    train, targets = rows
    pairs = train.where("user is not null").groupBy("item").agg(F.count("*").alias("n")).agg(F.sum(F.expr("n * (n - 1)"))).first()[0]
    plan = plan_join(train, train, "item", SMALL, deal="user")
    ranks = neighbors(similarity(pair_input(train, metric), metric, plan, ordered=True), 3, F.lit(10**6), 10**5)
    assert max(exchanges(ranks.where("sim > 0"))) < pairs / 4
    assert max(exchanges(predict_mod.predict(train, targets, metric, 5, skew=SMALL).where("prediction > 0"))) < pairs / 4
