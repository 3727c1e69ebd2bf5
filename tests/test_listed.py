"""Predictions over all users by lists of raters: the sums of the plain way, in fewer rows between tasks."""

import pytest
from pyspark.sql import functions as F

from tiny_data import SCHEMA

from kinship.operators import listed
from kinship.operators import predict as predict_mod
from kinship.operators.features import user_table
from kinship.operators.predict import all_users_sums, predict, predict_both_metrics
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy

METRICS = ("cosine", "jaccard")


@pytest.fixture(scope="module")
def rows(spark):
    """(train, targets) with unrated, repeated and ownerless rows, ids below 0 and cold targets."""
    every = spark.range(1_200).selectExpr(
        "id % 60 - 7 as user", "(id * 7 + id div 60) % 40 as item", "cast((id * 3 + id div 40) % 5 + 1 as double) as rating")
    every = spark.createDataFrame(every.dropDuplicates(["user", "item"]).collect(), SCHEMA)
    odd = spark.createDataFrame([(3, 5, None), (4, 5, None), (None, 5, 4.0), (6, None, 2.0), (9, 11, 3.0), (9, 11, 3.0)], SCHEMA)
    cold = spark.createDataFrame([(10**6, 5, 3.0), (4, 10**6, 2.0), (None, 5, 1.0), (8, None, 1.0), (8, 12, 1.0), (8, 12, 1.0)], SCHEMA)
    train = every.where("(7 * user + 13 * item) % 5 <> 0").unionByName(odd).cache()
    return train, every.where("(7 * user + 13 * item) % 5 = 0").unionByName(cold).cache()


def close(df):
    """Sorted rows, numbers within a billionth."""
    ids = sum(t in ("bigint", "int") for _, t in df.dtypes)
    found = sorted((list(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r[:ids]] + [str(r[ids:])[:6]])
    return [[pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in r] for r in found]


def same(one, other):
    return [[getattr(v, "expected", v) for v in r] for r in one] == other


def exchanges(df):
    """Rows that every shuffle of the executed plan sent."""
    out = []

    def walk(p):
        name = p.nodeName()
        if name == "Exchange":
            out.append(p.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlan":
            walk(p.executedPlan())
        elif name.endswith("QueryStage"):
            walk(p.plan())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return out


@pytest.mark.parametrize("skew", [DEFAULT_SKEW, SkewPolicy(pairs_per_task=400), SkewPolicy(bucket_rows=7, pairs_per_task=5_000)])
def test_lists_give_the_sums_of_the_plain_way(spark, rows, monkeypatch, skew):
    train, targets = rows
    users = user_table(train)
    got = close(all_users_sums(train, targets, users, METRICS, skew=skew))
    monkeypatch.setattr(predict_mod, "rating_codes", lambda *a: None)
    want = close(all_users_sums(train, targets, users, METRICS))
    assert same(got, want) and want


def test_cells_and_buckets_are_tried(spark, rows):
    train, _ = rows
    plan = listed.plan_join(train, train, "item", SkewPolicy(pairs_per_task=400), deal="user")
    assert plan.cells > 1 and listed.plan_join(train, train, "item", SkewPolicy(bucket_rows=7)).buckets is not None


@pytest.mark.parametrize("metric", METRICS)
def test_no_shuffle_holds_a_row_per_pair_or_candidate(spark, rows, metric, monkeypatch):
    train, targets = rows
    raters = train.where("user is not null").groupBy("item").agg(F.count("*").alias("n"))
    candidates = targets.join(raters, "item").agg(F.sum("n")).first()[0]
    pairs = raters.agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0]
    sent = exchanges(predict(train, targets, metric, skew=SkewPolicy(pairs_per_task=5_000)).where("prediction > 0"))
    users = train.select("user").distinct().count()
    # a list row for each rating and side; afterwards the matched rows, at most the candidates
    assert max(sent) < min(pairs, 3 * train.count() + targets.count() + candidates) and users < max(sent)
    assert len([n for n in sent if n >= candidates]) == 0
    monkeypatch.setattr(predict_mod, "rating_codes", lambda *a: None)
    plain = exchanges(predict(train, targets, metric, skew=SkewPolicy(pairs_per_task=5_000)).where("prediction > 0"))
    assert max(plain) > max(sent), (plain, sent, pairs, candidates)


def test_predictions_of_one_and_both_metrics_agree(spark, rows):
    train, targets = rows
    both, _ = predict_both_metrics(train, targets)
    for m in METRICS:
        assert same(close(both.select("user", "item", "rating", m)), close(predict(train, targets, m)))


def test_ratings_without_codes_go_the_plain_way(spark):
    fine = spark.range(600).selectExpr("id % 20 as user", "id % 31 as item", "1 + id / 200 as rating")
    targets = fine.where("user < 3")
    assert listed.rating_codes(fine, targets) is None  # more distinct ratings than codes
    assert predict(fine, targets).count() == targets.count()
    few = fine.withColumn("rating", F.lit(3.0))
    assert listed.rating_codes(few, targets).levels == (3.0,)
    assert listed.rating_codes(few.withColumn("user", F.col("user") + F.lit(2**62)), targets) is None
