"""What the plans do with hot keys, and how often they read and count."""

import contextlib
import os
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tiny_data import SF_SMALL, TINY_TARGETS, TINY_TRAIN

from kinship.operators import predict as predict_mod
from kinship.operators.evaluate import k_sweep
from kinship.operators.features import normalized_deviation, preprocess, user_table
from kinship.operators.neighbors import directed, neighbors
from kinship.operators.similarity import similarity
from kinship.operators.skew import _A, _B, SkewPolicy, _cut, plan_join
from kinship.operators.stats import summary_with_zeros
from kinship.plans.catalog import QUERIES
from kinship.plans.jobs import knn_job, recommend_job, similarity_job
from kinship.sources.files import ingest_personal, ingest_ratings


@contextlib.contextmanager
def settings(spark, **values):
    """Spark settings for a while; dots are written as double underscores."""
    keys = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": -1, "spark__sql__adaptive__autoBroadcastJoinThreshold": -1}
TINY_PARTS = {"spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k", "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k",
              "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2, "spark__sql__adaptive__coalescePartitions__enabled": "false", "spark__sql__files__maxPartitionBytes": "16k", "spark__sql__files__openCostInBytes": 1}


def nodes(df):
    """All nodes of the plan as it ran."""
    out = []

    def walk(p):
        name = p.nodeName()
        out.append(p)
        if name == "AdaptiveSparkPlan":
            walk(p.executedPlan())
        elif name.endswith("QueryStage"):
            walk(p.plan())
        children = p.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def join_rows(df):
    """The rows that each join gave."""
    return [p.metrics().apply("numOutputRows").value() for p in nodes(df) if "Join" in p.nodeName()]


def rows_per_task(df, key):
    """(most rows of key 0 in a task, all rows of key 0), with every column carried that far"""
    whole = F.bit_xor(F.xxhash64(*df.columns))
    return df.groupBy(F.spark_partition_id()).agg(F.count_if(F.col(key) == 0).alias("n"), whole.alias("x")).agg(
        F.max("n"), F.sum("n"), F.max("x")).first()


def executions(spark, after=-1):
    """The SQL executions with a larger id, as Spark's status store keeps them (the last 1,000)."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    every = spark._jsparkSession.sharedState().statusStore().executionsList()
    runs = [every.apply(i) for i in range(every.size() - 1, max(-1, every.size() - 200), -1)]
    return [r for r in runs if r.executionId() > after]


def last_execution(spark):
    return max((r.executionId() for r in executions(spark)), default=-1)


@pytest.fixture(scope="module")
def hot_rows(spark):
    """Half of all rows on one item, written so that they arrive in many map outputs."""
    rows = spark.range(0, 60_000, 1, 24).selectExpr("id as user", "if(id % 2 = 0, 0, id % 997 + 1) as item")
    path = os.path.join(tempfile.mkdtemp(prefix="kinship-hot-"), "rows")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_rows_of_a_hot_item_are_cut_before_they_get_their_buckets(spark, hot_rows):
    with settings(spark, **NO_BROADCAST, **TINY_PARTS):
        plan = plan_join(hot_rows, hot_rows, "item", SkewPolicy(bucket_rows=20_000))
        assert plan.buckets.collect() == [(0, 2, 2)]
        routed = _cut(hot_rows, "item", plan, "user", _A, _B, "_left", "_right")
        most = rows_per_task(routed, "item")
    # 30,000 rows, each copied to the two buckets of the other side
    assert most[1] == 60_000 and most[0] <= 60_000 / 5


def test_partition_count_is_bounded(spark, hot_rows):
    plan = plan_join(hot_rows, hot_rows, "item", SkewPolicy(bucket_rows=1000, pairs_per_task=1000, max_partitions=64))
    assert plan.partitions == 64


def test_one_job_counts_both_sides(spark, hot_rows):
    left = hot_rows.where("user % 3 = 0")
    before = last_execution(spark)
    plan = plan_join(left, hot_rows, "item", SkewPolicy(bucket_rows=1000), wide=30)
    assert len(executions(spark, before)) == 1
    assert plan.buckets.count() == 1 and 1 < plan.wide.count() < 998
    before = last_execution(spark)
    plan = plan_join(left, hot_rows, "item", SkewPolicy(bucket_rows=10**6))
    assert len(executions(spark, before)) == 1 and plan.buckets is None and plan.wide is None
    nothing = hot_rows.where("user < 0")
    assert plan_join(nothing, nothing, "item", wide=3) == plan_join(nothing, hot_rows, "item")


@pytest.mark.parametrize("make", [normalized_deviation, preprocess])
def test_users_join_as_plain_shuffles(spark, hot_rows, make):
    ratings = hot_rows.selectExpr("item as user", "user as item", "cast(user % 5 + 1 as double) as rating")  # a hot user
    with settings(spark, **NO_BROADCAST, **TINY_PARTS):
        df = make(ratings)
        most = rows_per_task(df, "user")
        df.collect()
        names = [p.nodeName() for p in nodes(df)]
    assert most[1] == 30_000 and most[0] <= 30_000 / 8
    assert not [n for n in names if "Aggregate" in n]
    assert len([n for n in names if "Join" in n]) == 1


@pytest.mark.parametrize("key", ["normalized_deviation", "preprocessed", "predict_cosine_all", "predict_jaccard_k30", "knn_lowest_k"])
def test_user_means_are_computed_once_a_query(spark, monkeypatch, key):
    import kinship.operators.features as feat

    written = []
    write = feat.write_table
    monkeypatch.setattr(feat, "write_table", lambda df, name: written.append(name) or write(df, name))
    df = QUERIES[key](spark, SF_SMALL)
    df.collect()
    assert written.count("user-means") == 1 and written.count("users") <= 1
    assert "avg(rating" not in df._jdf.queryExecution().executedPlan().toString()


def test_item_with_very_many_raters_goes_neighbour_first(spark):
    """10,000 raters of one item: rater first it costs 10,000 rows a target, here k rows."""
    n, k, users = 10_000, 3, 40
    hub = spark.range(n).selectExpr("id as user", "0L as item", "cast(id % 5 + 1 as double) as rating")
    small = spark.range(users * 6).selectExpr("id % 40 as user", "1 + (id * 7) % 29 as item", "cast((id * 3 + id div 40) % 5 + 1 as double) as rating").dropDuplicates(["user", "item"])
    train = hub.unionByName(small)
    targets = spark.range(users).selectExpr("id as user", "if(id % 2 = 0, 0L, 1 + id % 29) as item", "3.0D as rating")
    table = user_table(train)
    dev = normalized_deviation(train, users=table)
    # neighbours by the small items alone, or the hub would pair all of its raters
    ranked = neighbors(directed(similarity(preprocess(small))), k, F.lit(users))
    plan = plan_join(targets, train, "item", wide=k)
    plain = predict_mod.ranked_candidates(targets, dev, ranked)
    mixed = predict_mod.ranked_candidates(targets, dev, ranked, plan)
    assert plan.wide.where("item = 0").count() == 1

    def close(df):
        return sorted((r.user, r.item, r.neighbour, r["rank"], round(r.dev, 9), round(r.sim, 9)) for r in df.collect())

    assert close(plain) == close(mixed) != []
    many, few = max(join_rows(plain)), max(join_rows(mixed))
    assert many >= users / 2 * (n - 1)
    assert few <= max(n + users * 6, users * k, users * 29)  # the ratings joined with their users' means


def test_sweep_is_the_same_by_either_way(spark):
    train = spark.createDataFrame(TINY_TRAIN, "user long, item long, rating double")
    targets = spark.createDataFrame(TINY_TARGETS, "user long, item long, rating double")
    got = {r.k: round(r.mae, 6) for r in k_sweep(train, targets, (1,)).collect()}  # items with two or more raters: neighbour first
    assert got == {1: 0.925}
    with pytest.raises(ValueError):
        k_sweep(train, targets, (0, 3))


def _lines(name, rows):
    path = os.path.join(tempfile.mkdtemp(prefix="kinship-scale-"), name)
    with open(path, "w") as f:
        f.writelines(rows)
    return path


def _ratings(name, rows):
    return _lines(name, [f"{u}\t{i}\t{r}\t874965758\n" for u, i, r in rows])


def test_jobs_read_every_text_file_once(spark):
    train, test = _ratings("a.base", TINY_TRAIN), _ratings("a.test", TINY_TARGETS)
    personal = _lines("personal.csv", ["10,A,5\n", "20,B\n", "30,C,1\n", "40,D,\n", "50,E\n", "60,F\n"])
    jobs = [(lambda: similarity_job(spark, train, test), (train, test)), (lambda: knn_job(spark, train, test, ks=(1, 3)), (train, test)),
            (lambda: recommend_job(spark, train, personal, ks=(2, 6), user=7), (train, personal))]
    for job, inputs in jobs:
        before = last_execution(spark)
        job().collect()
        scans = defaultdict(list)
        for run in executions(spark, before):
            for path in inputs:
                if path in run.physicalPlanDescription():
                    scans[path].append(run.rootExecutionId())
        for path in inputs:
            assert len(set(scans[path])) == 1, (path, scans[path])  # one write, and the command around it


def test_ingested_ratings_are_checked_and_stand_by_item(spark):
    good = ingest_ratings(spark, _ratings("good", TINY_TRAIN), rows=len(TINY_TRAIN))
    assert sorted(map(tuple, good.collect())) == sorted(TINY_TRAIN)
    with settings(spark, **NO_BROADCAST):
        pairs = good.join(good.withColumnRenamed("user", "other"), "item")
        pairs.collect()
        assert not [p for p in nodes(pairs) if p.nodeName() in ("Exchange", "ShuffleQueryStage")]
    assert ingest_ratings(spark, _lines("empty", []), rows=0).count() == 0
    for rows, word in [(TINY_TRAIN + [(1, 10, 4.0)], "duplicate"), ([(1, 2, "NaN")], "NaN"), ([(1, 2, 7)], "outside"), ([(1, 2, 0.5)], "outside")]:
        with pytest.raises(ValueError, match=word):
            ingest_ratings(spark, _ratings("bad", rows))
    with pytest.raises(ValueError, match="expected 3 rows, found 16"):
        ingest_ratings(spark, _ratings("good", TINY_TRAIN), rows=3)
    with pytest.raises(Exception, match="no rating|MALFORMED|Malformed"):
        ingest_ratings(spark, _lines("short", ["1\t2\n"]))
    for lines, word in [(["1,A,5\n", "1,B\n"], "repeated"), (["1,A,9\n"], "outside")]:
        with pytest.raises(ValueError, match=word):
            ingest_personal(spark, _lines("personal.csv", lines))


def test_recommendations_for_several_k_share_one_pair_table(spark, monkeypatch):
    joins, pairs = [], predict_mod.similarity
    monkeypatch.setattr(predict_mod, "similarity", lambda *a, **b: joins.append(1) or pairs(*a, **b))
    personal = _lines("personal.csv", ["10,A,5\n", "20,B\n", "30,C,1\n", "40,D,\n", "50,E\n", "60,F\n"])
    rows = recommend_job(spark, _ratings("data", TINY_TRAIN), personal, ks=(30, 300), user=7).collect()
    assert len(joins) == 1 and {r.k for r in rows} == {30, 300}


def test_variance_does_not_cancel(spark):
    values = spark.range(10_000).selectExpr("100000000D + if(id % 2 = 0, 1D, -1D) as v")
    row = summary_with_zeros(values, "v", F.lit(10_000)).first()
    assert row["mean_value"] == 1e8 and row["stddev_value"] == pytest.approx(1.0, abs=1e-9) and row["min_value"] == 1e8 - 1
    half = summary_with_zeros(values, "v", F.lit(20_000)).first()
    assert half["mean_value"] == 5e7 and half["stddev_value"] == pytest.approx((25e14 + 0.5) ** 0.5, rel=1e-15) and half["min_value"] == 0
    none = summary_with_zeros(values.where("v < 0"), "v", F.lit(5)).first()
    assert (none["n_nonzero"], none["mean_value"], none["stddev_value"]) == (0, 0.0, 0.0)
