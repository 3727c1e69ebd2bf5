"""Error measures: MAE, the k sweep and the lowest k that beats a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, SIM_DIGITS, RatingScale
from kinship.operators.blocks import block_plan, block_ratios
from kinship.operators.features import known_users, normalized_deviation, user_table
from kinship.operators.neighbors import ranked_all
from kinship.operators.predict import (
    WIDE_TIMES,
    attach_similarity,
    candidates,
    finish,
    finish_per_k,
    metric_name,
    ordered_users,
    positive,
    predict_per_k,
    ratios_per_k,
)
from kinship.operators.similarity import METRICS, needs_norms
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy, plan_join
from kinship.session import write_table

# The neighbourhood sizes swept and the constant baseline MAE.
REFERENCE_KS = (10, 30, 50, 100, 200, 300, 400, 800, 943)
BASELINE_MAE = 0.7669


def mae(predictions: DataFrame) -> DataFrame:
    """One row: ``mae``, mean absolute error of ``prediction`` against ``rating``."""
    return predictions.agg(mean_error("prediction").alias("mae"))


def mean_error(prediction: str) -> Column:
    """Mean absolute error of a column of predictions against ``rating``, as an aggregate."""
    return F.avg(F.abs(F.col("rating") - F.col(prediction)))


def mae_of_metrics(predictions: DataFrame) -> DataFrame:
    """One row ``(cosine_mae, jaccard_mae)`` from the predictions of both metrics."""
    return predictions.agg(*[mean_error(m).alias(f"{m}_mae") for m in METRICS])


def mae_value(predictions: DataFrame) -> Column:
    return mae(predictions).scalar()


def k_sweep(
    train: DataFrame,
    targets: DataFrame,
    ks: Sequence[int] = REFERENCE_KS,
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
    wide_times: int = WIDE_TIMES,
) -> DataFrame:
    """``(k, mae)`` for every ``k`` in ``ks`` (all > 0) in one pass.

    Neighbours are ranked once, up to the largest ``k``; the candidate rows of
    every target meet those ranks once and are summed with one
    conditional sum per ``k``, so the cost does not grow with ``len(ks)``. An item with
    more raters than ``wide_times`` the largest ``k`` is reached through the ranked neighbours of
    its targets' users, so no item costs more than ``k`` rows a target.
    """
    ks = positive(ks)
    return _mae_per_k(predict_per_k(train, targets, ks, metric, bounds, skew, wide_times=wide_times))


def _mae_per_k(preds: DataFrame) -> DataFrame:
    return preds.groupBy("k").agg(mean_error("prediction").alias("mae"))


def sweep_and_baseline(
    train: DataFrame,
    targets: DataFrame,
    ks: Sequence[int] = REFERENCE_KS,
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> tuple[DataFrame, DataFrame]:
    """``k_sweep`` and the all-users predictions, from one written row of weighted deviations per target.
    The baseline weighs every candidate, so all of them meet the ranked pairs rater first, in blocks of
    users where that suits."""
    ks = positive(ks)
    users = user_table(train, needs_norms(metric), bounds)
    plan = plan_join(train, train, "item", skew, deal="user")
    blocks = block_plan(train, plan)
    if blocks is not None:
        ratios = block_ratios(train, targets, users, blocks, metric_name(metric), ks, bounds, everyone=True)
    else:
        dev = normalized_deviation(train, bounds, users)
        hot = plan_join(targets, train, "item", skew)
        ranked = ranked_all(ordered_users(train, metric, bounds, plan, users), known_users(users))
        if plan.partitions:
            ranked = ranked.repartition(plan.partitions, "user", "neighbour")
        ratios = ratios_per_k(attach_similarity(candidates(targets, dev, hot), ranked, lower=False), ks)
    written = write_table(ratios, f"ratios-{metric}")
    return _mae_per_k(finish_per_k(targets, users, written, ks, bounds)), finish(targets, users, written, bounds)


def lowest_k(sweep: DataFrame, baseline: Column | float) -> DataFrame:
    """One row ``(k, mae, mae_minus_baseline)``: the smallest ``k`` whose MAE is
    below ``baseline``; all NULL when no ``k`` is.

    Both sides are compared after rounding to 12 decimals: a ``k`` at least the
    number of users reproduces the all-users MAE exactly in real arithmetic, and
    summation-order noise must not decide whether it "beats" it."""
    base = baseline if isinstance(baseline, Column) else F.lit(float(baseline))
    better = F.round(F.col("mae"), SIM_DIGITS) < F.round(base, SIM_DIGITS)
    best = sweep.where(better).agg(
        F.min("k").alias("k"), F.min_by("mae", "k").alias("mae")
    )
    return best.select("k", "mae", (F.col("mae") - base).alias("mae_minus_baseline"))
