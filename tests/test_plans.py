"""Physical-plan properties that matter at scale."""

import re

import pytest

from tiny_data import SF_SMALL
from kinship.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _executed(df):
    df.collect()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("key", ["predict_cosine_all", "predict_jaccard_k30", "knn_sweep",
                                 "overlap_stats", "report_similarity"])
def test_no_pairs_of_everything_and_no_python(spark, key):
    plan = _executed(QUERIES[key](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)


def test_recommender_reads_one_user(spark):
    """The personal user id is a constant, so Catalyst pushes ``user = -1`` into
    the scans of the per-user tables; the one join left without an equi-key
    (targets with that user's mean) has a one-row build side."""
    plan = _executed(QUERIES["recommend_k30"](spark, SF_SMALL))
    for op in FORBIDDEN[:1] + FORBIDDEN[2:]:
        assert op not in plan, op
    assert "DataFilters: [isnotnull(user), (-1 = user)]" in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("BroadcastNestedLoopJoin") <= final.count("BroadcastExchange IdentityBroadcastMode")


def test_topk_is_limited_before_the_shuffle(spark):
    plan = _executed(QUERIES["neighbors_cosine_k10"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_columns(spark):
    df = QUERIES["user_avg"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the three columns the rating view needs are read from lineitem
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_eager_writes_hold_one_self_join(spark, monkeypatch):
    """The pair table of a k-NN question is planned once, across the eager writes and
    the result, and no written plan holds an operator that pairs everything."""
    import kinship.session as session_mod
    from kinship.operators import evaluate, similarity

    plans, joins = [], []
    write, pairs = session_mod.write_table, similarity.co_ratings
    monkeypatch.setattr(evaluate, "write_table", lambda df, name: plans.append(_executed(df)) or write(df, name))
    monkeypatch.setattr(similarity, "co_ratings", lambda *a, **b: joins.append(1) or pairs(*a, **b))
    QUERIES["knn_lowest_k"](spark, SF_SMALL).collect()
    assert len(joins) == 1 and len(plans) == 1
    for op in FORBIDDEN:
        assert op not in plans[0], op


def test_linear_statistics_have_no_self_join(spark):
    plan = _executed(QUERIES["multiplications_total"](spark, SF_SMALL))
    assert "Join" not in plan
    assert "Expand" not in _executed(QUERIES["ratings_profile"](spark, SF_SMALL))
    for key in ("co_ratings", "overlap_stats", "similarity_jaccard"):
        assert not re.search(r"\bnorm\b|\bndev", _executed(QUERIES[key](spark, SF_SMALL))), key
