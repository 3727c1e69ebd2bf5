"""Rating prediction: user mean plus a similarity-weighted neighbour deviation.

For a target ``(u, i)`` the candidates are the train ratings of item ``i`` by
other users ``v`` (join on ``item``); each candidate is weighted by ``s(u, v)``
(join on the user pair) and the sums are grouped per target:

    w(u, i) = sum dev(v, i) * s(u, v) / sum |s(u, v)|      (0 if no candidate)
    pred    = avg(u) + w * scale(avg(u) + w, avg(u))        (global mean if u unknown)

Pairs with similarity 0 add nothing to either sum, so only non-zero
similarities are joined. With ``k > 0`` the pair table holds each user's ``k``
nearest neighbours only, and several ``k`` share one ranking: a conditional sum for
each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, RatingScale, rescale, safe_ratio
from kinship.operators.blocks import block_plan, block_ranks, block_ratios, block_sums
from kinship.operators.features import known_users, normalized_deviation, overall_mean, preprocess, user_table
from kinship.operators.listed import listed_sums, rating_codes
from kinship.operators.neighbors import neighbors
from kinship.operators.packed import ordered_rows
from kinship.operators.similarity import (
    METRICS, all_pairs, co_ratings, needs_norms, pair_input, pair_sums, similarity, similarity_from_pairs, similarity_value)
from kinship.operators.skew import DEFAULT_SKEW, JoinPlan, SkewPolicy, plan_join, salted_join
from kinship.session import write_table

# Estimated, not measured: a candidate in a list takes a fourth of the bytes of a row of ``neighbour_first``.
WIDE_TIMES = 4


def metric_name(metric: str) -> str:
    return "cosine" if needs_norms(metric) else "jaccard"


def candidates(targets: DataFrame, dev: DataFrame, hot: JoinPlan | None = None) -> DataFrame:
    """``(user, item, neighbour, dev)``: train ratings of each target item by
    users other than the target user. ``dev`` is ``normalized_deviation(train)``
    (the norm is not needed here, so it is not joined)."""
    wanted = targets.select("user", "item")
    raters = dev.select(F.col("user").alias("neighbour"), "item", "dev")
    return salted_join(wanted, raters, "item", hot, "user", "neighbour").where(
        F.col("user") != F.col("neighbour")
    ).select("item", "user", "dev", "neighbour")


def attach_similarity(cands: DataFrame, pairs: DataFrame, lower: bool) -> DataFrame:
    """Join candidates with the pair table; ``lower`` pairs are looked up as
    ``(greatest(u, v), least(u, v))`` so the triangle need not be mirrored."""
    if not lower:
        return cands.join(pairs, ["user", "neighbour"])
    tri = pairs.select(F.col("user").alias("_hi"), F.col("neighbour").alias("_lo"), *[
        c for c in pairs.columns if c not in ("user", "neighbour")
    ])
    cond = (F.greatest("user", "neighbour") == F.col("_hi")) & (F.least("user", "neighbour") == F.col("_lo"))
    return cands.join(tri, cond).drop("_hi", "_lo")


def weighted_deviation(
    targets: DataFrame,
    dev: DataFrame,
    pairs: DataFrame,
    hot: JoinPlan | None = None,
    lower: bool = False,
) -> DataFrame:
    """``(user, item, num, den, w)`` for targets with at least one weighted
    candidate; others get ``w = 0`` in ``predict``."""
    weighted = attach_similarity(candidates(targets, dev, hot), pairs, lower)
    return (
        weighted.groupBy("user", "item")
        .agg(
            F.sum(F.col("dev") * F.col("sim")).alias("num"),
            F.sum(F.abs(F.col("sim"))).alias("den"),
        )
        .withColumn("w", safe_ratio("num", "den"))
    )


def all_users_sums(train: DataFrame, targets: DataFrame, users: DataFrame, metrics: Sequence[str], bounds: RatingScale = DEFAULT_SCALE,
                   skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """``(user, item, num_<metric>, den_<metric>, ...)``: the sums of ``weighted_deviation`` over all
    users, where the ratings have codes in blocks of users, or by lists of raters (``kinship.operators.listed``) where
    those do not suit."""
    codes = rating_codes(train, targets)
    if codes is not None:
        plan = plan_join(train, train, "item", skew, deal="user")
        blocks = block_plan(train, plan, codes)
        if blocks is not None:
            return block_sums(train, targets, users, blocks, metrics, bounds)
        return listed_sums(train, targets, users, metrics, codes, bounds, skew, plan)
    dev = normalized_deviation(train, bounds, users)
    hot = plan_join(targets, train, "item", skew)
    if len(metrics) == 1:
        w = weighted_deviation(targets, dev, similar_users(train, metrics[0], bounds, skew, None, users), hot, lower=True)
        return w.select("user", "item", F.col("num").alias(f"num_{metrics[0]}"), F.col("den").alias(f"den_{metrics[0]}"))
    co = co_ratings(preprocess(train, bounds, users), plan_join(train, train, "item", skew))
    weighted = attach_similarity(candidates(targets, dev, hot), both_similarities(co), lower=True)
    return weighted.groupBy("user", "item").agg(*[
        f for m in metrics for f in (F.sum(F.col("dev") * F.col(m)).alias(f"num_{m}"), F.sum(F.abs(F.col(m))).alias(f"den_{m}"))])


def similar_users(train: DataFrame, metric: str, bounds: RatingScale = DEFAULT_SCALE, skew: SkewPolicy = DEFAULT_SKEW,
                  for_users: DataFrame | None = None, users: DataFrame | None = None) -> DataFrame:
    """The non-zero similarities a prediction needs: the triangle, or for ``for_users``
    ordered pairs. Only the side that is asked for counts as the left of the join."""
    pre = pair_input(train, metric, bounds, users)
    own = train if for_users is None else train.join(for_users.select("user").distinct(), "user", "left_semi")
    return similarity(pre, metric, plan_join(own, train, "item", skew), for_users)


def ordered_users(train: DataFrame, metric: str, bounds: RatingScale, plan: JoinPlan, users: DataFrame) -> DataFrame:
    """The non-zero similarities of all users in both orders; ``plan``: of the join of ``train`` with itself."""
    return similarity(pair_input(train, metric, bounds, users), metric, plan, ordered=True)


def nearest(train: DataFrame, users: DataFrame, metric: str, k: int, bounds: RatingScale = DEFAULT_SCALE, skew: SkewPolicy = DEFAULT_SKEW,
            for_users: DataFrame | None = None) -> DataFrame:
    """The ``k`` (> 0) nearest neighbours of each user. All users' pairs are dealt out by the
    user, in blocks where that suits, and ranked where they stand. Those of ``for_users`` are few; cosine has negative
    values, which makes two consumers of the pairs (the ranks and a count per user), so
    they are written once to the shared folder; this runs a job while the plan is built."""
    if for_users is None:
        plan = plan_join(train, train, "item", skew, deal="user")
        blocks = block_plan(train, plan)
        if blocks is not None:
            return block_ranks(train, users, blocks, metric_name(metric), k, bounds)
        return neighbors(ordered_users(train, metric, bounds, plan, users), k, known_users(users), plan.spare)
    sims = similar_users(train, metric, bounds, skew, for_users, users)
    return neighbors(sims if metric == "jaccard" else write_table(sims, f"similarity-{metric}"), k, known_users(users))


def neighbour_first(targets: DataFrame, dev: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(user, item, neighbour, dev, sim, rank)``: targets meet their user's ranked neighbours
    first and then the neighbours' ratings, so the rows in between are ``targets * k``
    however many raters an item has."""
    wanted = targets.select("user", "item").distinct().join(ranked.select("user", "neighbour", "sim", "rank"), "user")
    raters = dev.select(F.col("user").alias("neighbour"), "item", "dev")
    return wanted.join(raters, ["neighbour", "item"]).select("user", "item", "neighbour", "dev", "sim", "rank")


def ranked_lists(train: DataFrame, targets: DataFrame, users: DataFrame, metric: str, k: int, bounds: RatingScale, skew: SkewPolicy,
                 hot: JoinPlan | None = None, plan: JoinPlan | None = None) -> DataFrame:
    """The rows of ``neighbour_first`` where no item is wide and blocks do not suit: pairs and candidates are sent to the
    left user's task as lists of raters (``kinship.operators.packed``), where a pair gets its similarity,
    its rank and the targets that it answers. No row of a pair or candidate is sent."""
    plan = plan_join(train, train, "item", skew, deal="user") if plan is None else plan
    pre = pair_input(train, metric, bounds, users)
    rows, pair = ordered_rows(pre, plan, targets, normalized_deviation(train, bounds, users), hot)
    met = rows.groupBy(*pair).agg(
        *pair_sums(pre.columns, F.col("shared")), F.collect_list(F.when(F.col("shared") == 0, F.struct("item", "dev"))).alias("asked"))
    sims = similarity_from_pairs(met.where(F.col("overlap") > 0), metric, also=["asked"])
    ranked = neighbors(sims, k, known_users(users), plan.spare, also=["asked"])
    return ranked.select("user", "neighbour", "sim", "rank", F.explode("asked").alias("a")).select(
        "user", "a.item", "neighbour", "a.dev", "sim", "rank")


def ranked_candidates(targets: DataFrame, dev: DataFrame, ranked: DataFrame, hot: JoinPlan | None = None) -> DataFrame:
    """The rows of ``neighbour_first``, by the cheaper way for every item: an item with
    ``t`` targets and ``n`` raters costs ``t * n`` rows rater first and ``t * k`` neighbour first,
    so the items with more than ``k`` raters (``hot.wide``, planned with ``wide=k``) go
    neighbour first and the others rater first."""
    slim = ranked.select("user", "neighbour", "sim", "rank")
    dealt = lambda df: df.repartition(hot.partitions, "user", "neighbour") if hot and hot.partitions else df
    by_rater = lambda t, d: attach_similarity(dealt(candidates(t, d, hot)), dealt(slim), lower=False).select(
        "user", "item", "neighbour", "dev", "sim", "rank")
    if hot is None or hot.wide is None:
        return by_rater(targets, dev)
    part = lambda df, how: df.join(hot.wide, "item", how)
    return by_rater(part(targets, "left_anti"), part(dev, "left_anti")).unionByName(
        neighbour_first(part(targets, "left_semi"), part(dev, "left_semi"), slim))


def prediction(users: DataFrame, w: Column, bounds: RatingScale) -> Column:
    """The rating that ``w`` gives around ``avg_rating``; the global mean for an unknown user."""
    return F.when(F.col("avg_rating").isNull(), overall_mean(users)).otherwise(rescale("avg_rating", w, bounds))


def finish(targets: DataFrame, users: DataFrame, w: DataFrame, bounds: RatingScale) -> DataFrame:
    """Attach user means and the global mean; one output row per target row."""
    pred = prediction(users, F.coalesce(F.col("w"), F.lit(0.0)), bounds)
    return (
        targets.select("user", "item", "rating")
        .join(w.select("user", "item", "w"), ["user", "item"], "left")
        .join(users.select("user", "avg_rating"), "user", "left")
        .select("user", "item", "rating", pred.alias("prediction"))
    )


def sums_per_k(weighted: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(user, item, num, den, num_k, den_k, ...)`` from the ranked rows of all targets:
    one grouping with a conditional sum per ``k``, and the sums over every row."""
    num, den = F.col("dev") * F.col("sim"), F.abs(F.col("sim"))
    sums = [F.sum(num).alias("num"), F.sum(den).alias("den")]
    for k in ks:
        inside = F.col("rank") <= k
        sums.append(F.sum(F.when(inside, num)).alias(f"num_{k}"))
        sums.append(F.sum(F.when(inside, den)).alias(f"den_{k}"))
    return weighted.groupBy("user", "item").agg(*sums)


def ratios_per_k(weighted: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(user, item, w, w_<k>, ...)``: the weighted deviations that ``sums_per_k`` gives, ``w`` over every row."""
    ratio = lambda end: safe_ratio(f"num{end}", f"den{end}").alias(f"w{end}")
    return sums_per_k(weighted, ks).select("user", "item", ratio(""), *[ratio(f"_{k}") for k in ks])


def finish_per_k(targets: DataFrame, users: DataFrame, ratios: DataFrame, ks: Sequence[int], bounds: RatingScale) -> DataFrame:
    """``(k, user, item, rating, prediction)``, one row per target row and ``k``, from the
    targets' ``ratios_per_k``."""
    rows = (
        targets.select("user", "item", "rating")
        .join(ratios.drop("w"), ["user", "item"], "left")
        .join(users.select("user", "avg_rating"), "user", "left")
    )
    per_k = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.coalesce(F.col(f"w_{k}"), F.lit(0.0)).alias("w")) for k in ks]))
    pred = prediction(users, F.col("s.w"), bounds)
    return rows.select("user", "item", "rating", "avg_rating", per_k.alias("s")).select(
        F.col("s.k").alias("k"), "user", "item", "rating", pred.alias("prediction"))


def _nearest_ratios(train: DataFrame, targets: DataFrame, metric: str, ks: Sequence[int], bounds: RatingScale, skew: SkewPolicy,
                    only_target_users: bool, wide_times: int) -> tuple[DataFrame, DataFrame]:
    """The user table, and the targets' ``ratios_per_k``; for all users by blocks or lists, or where
    an item has more than ``wide_times`` raters for each of the largest ``k`` by the cheaper way for every item."""
    k = ks[-1]
    users = user_table(train, needs_norms(metric), bounds)
    dev = normalized_deviation(train, bounds, users)
    if only_target_users:
        return users, ratios_per_k(neighbour_first(targets, dev, nearest(train, users, metric, k, bounds, skew, targets.select("user"))), ks)
    hot = plan_join(targets, train, "item", skew, wide=wide_times * k)
    if hot.wide is None:
        plan = plan_join(train, train, "item", skew, deal="user")
        blocks = block_plan(train, plan)
        if blocks is not None:
            return users, block_ratios(train, targets, users, blocks, metric_name(metric), ks, bounds)
        return users, ratios_per_k(ranked_lists(train, targets, users, metric, k, bounds, skew, hot, plan), ks)
    # read by both ways to the candidates
    ranked = write_table(nearest(train, users, metric, k, bounds, skew), f"ranked-{metric}")
    return users, ratios_per_k(ranked_candidates(targets, dev, ranked, hot), ks)


def predict(
    train: DataFrame,
    targets: DataFrame,
    metric: str = "cosine",
    k: int = 0,
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
    only_target_users: bool = False,
) -> DataFrame:
    """``(user, item, rating, prediction)`` for every row of ``targets``.

    ``k = 0`` weighs all users, ``k > 0`` the ``k`` most similar ones.
    ``only_target_users`` computes similarities for the target users only
    (ordered pairs) instead of the whole triangle; worth it when few users are
    asked for, as in a recommendation for one user.
    """
    if k > 0:
        return predict_per_k(train, targets, (k,), metric, bounds, skew, only_target_users).drop("k")
    users = user_table(train, needs_norms(metric), bounds)
    if not only_target_users:
        m = metric_name(metric)
        sums = all_users_sums(train, targets, users, (m,), bounds, skew)
        return finish(targets, users, sums.select("user", "item", safe_ratio(f"num_{m}", f"den_{m}").alias("w")), bounds)
    sims = similar_users(train, metric, bounds, skew, targets.select("user"), users)
    hot = plan_join(targets, train, "item", skew)
    w = weighted_deviation(targets, normalized_deviation(train, bounds, users), sims, hot)
    return finish(targets, users, w, bounds)


def predict_per_k(
    train: DataFrame,
    targets: DataFrame,
    ks: Sequence[int],
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
    only_target_users: bool = False,
    wide_times: int = WIDE_TIMES,
) -> DataFrame:
    """``(k, user, item, rating, prediction)`` for every target row and every ``k`` (all > 0):
    similarities and ranks are computed once, up to the largest ``k``. ``wide_times``: an item with more
    raters than this times ``k`` goes neighbour first."""
    ks = positive(ks)
    users, ratios = _nearest_ratios(train, targets, metric, ks, bounds, skew, only_target_users, wide_times)
    return finish_per_k(targets, users, ratios, ks, bounds)


def positive(ks: Sequence[int]) -> list[int]:
    ks = sorted({int(k) for k in ks})
    if not ks or ks[0] <= 0:
        raise ValueError("numbers of neighbours must be positive")
    return ks


def predict_both_metrics(
    train: DataFrame,
    targets: DataFrame,
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> tuple[DataFrame, DataFrame]:
    """All-users (k = 0) predictions for both metrics, ``(user, item, rating, cosine, jaccard)``,
    and the co-rating table with all values of its pairs (lazy: a plan that only predicts
    never makes it).

    Cosine and Jaccard differ only in how a pair's similarity is computed from the same
    common ratings, so the pairs meet the candidates once.
    """
    users = user_table(train, True, bounds)
    sums = all_users_sums(train, targets, users, METRICS, bounds, skew)
    rows = targets.select("user", "item", "rating").join(sums, ["user", "item"], "left").join(
        users.select("user", "avg_rating"), "user", "left")
    preds = [prediction(users, safe_ratio(f"num_{m}", f"den_{m}"), bounds).alias(m) for m in METRICS]
    return rows.select("user", "item", "rating", *preds), all_pairs(train, METRICS, bounds, skew, users)


def both_similarities(co: DataFrame) -> DataFrame:
    """``(user, neighbour, overlap, cosine, jaccard)`` of a table with all values of its pairs."""
    return co.select("user", "neighbour", "overlap", *[similarity_value(m).alias(m) for m in METRICS])
