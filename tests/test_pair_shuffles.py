"""Pairs of users: how many a task holds, and how often they are shuffled or written."""

import pytest
from pyspark.sql import functions as F

from tiny_data import SCHEMA, TINY_TRAIN

from kinship.operators import predict as predict_mod
from kinship.operators.neighbors import directed, neighbors, ranked_all
from kinship.operators.similarity import co_ratings, pair_input, similarity
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy, plan_join

SMALL = SkewPolicy(pairs_per_task=2_000)


@pytest.fixture(scope="module")
def ratings(spark):
    rows = spark.range(4_000).selectExpr("id % 150 as user", "(id * 7 + id div 150) % 90 as item", "cast((id * 3 + id div 40) % 5 + 1 as double) as rating")
    return spark.createDataFrame(rows.dropDuplicates(["user", "item"]).collect(), SCHEMA)


def plan_text(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def close(df):
    return sorted((r.user, r.neighbour, round(r.sim, 9), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("ordered", [False, True])
@pytest.mark.parametrize("metric", [None, "cosine", "jaccard"])
def test_summed_pairs_of_a_task_are_bounded(spark, ratings, metric, ordered):
    plan = plan_join(ratings, ratings, "item", SMALL, deal="user" if ordered else None)
    assert plan.partitions > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = co_ratings(pair_input(ratings, metric), plan, ordered=ordered)
    most = pairs.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 3 * SMALL.pairs_per_task
    plain = co_ratings(pair_input(ratings, metric))
    assert pairs.count() == plain.count() * (2 if ordered else 1)
    if ordered and metric == "jaccard":  # the counts stand on their own sides
        own = {r.user: r.n for r in ratings.groupBy("user").agg(F.count("*").alias("n")).collect()}
        assert all((r.n_user, r.n_neighbour) == (own[r.user], own[r.neighbour]) for r in pairs.collect())


def test_a_task_of_the_library_holds_few_million_pairs():
    assert DEFAULT_SKEW.pairs_per_task <= 4_000_000


@pytest.mark.parametrize("metric, k", [("cosine", 5), ("cosine", 149), ("jaccard", 60)])
def test_ranks_are_the_same_however_the_pairs_are_dealt(spark, ratings, metric, k):
    n = F.lit(150)
    want = close(neighbors(directed(similarity(pair_input(ratings, metric), metric)), k, n))
    plan = plan_join(ratings, ratings, "item", SMALL, deal="user")
    assert plan_join(ratings, ratings, "item", SkewPolicy(pairs_per_task=200), deal="user").cells > 1
    for cells in (1, 3):
        dealt = similarity(pair_input(ratings, metric), metric, predict_mod.JoinPlan(plan.buckets, plan.partitions, cells=cells), ordered=True)
        assert close(neighbors(dealt, k, n, plan.spare)) == want
        assert close(ranked_all(dealt, n).where(F.col("rank") <= k)) == want


def test_spare_neighbours_leave_no_rank_to_a_negative_one(spark):
    train = spark.createDataFrame(TINY_TRAIN, SCHEMA)
    assert plan_join(train, train, "item", deal="user").spare == 6 - 1 - 3 * 4
    lone = train.unionByName(spark.range(100, 120).selectExpr("id as user", "id as item", "3D as rating"))
    plan = plan_join(lone.cache(), lone, "item", deal="user")
    sims = similarity(pair_input(lone, "cosine"), "cosine", ordered=True)
    assert plan.spare == 26 - 1 - 12 and sims.where("sim < 0").count() > 0
    assert close(neighbors(sims, plan.spare, F.lit(26), plan.spare)) == close(neighbors(sims, plan.spare, F.lit(26)))
    assert plan_join(train.where("user > 2"), train, "item", deal="user").spare is None


def test_ranks_follow_the_pairs_without_a_shuffle(spark, ratings):
    plan = plan_join(ratings, ratings, "item", SMALL, deal="user")
    one = predict_mod.JoinPlan(plan.buckets, plan.partitions, spare=10**6)
    text = plan_text(neighbors(similarity(pair_input(ratings, "jaccard"), "jaccard", one, ordered=True), 5, F.lit(150), one.spare))
    assert text.count("Exchange hashpartitioning(user") == 1
