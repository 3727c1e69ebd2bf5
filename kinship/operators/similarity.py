"""User-user similarity from co-rated items (adjusted cosine or Jaccard).

Only pairs that share an item are ever materialised: the ratings are joined
with themselves on ``item`` and the products are summed per user pair, so the
work is ``sum_i n_i^2 / 2`` and not ``users^2``. A pair without a common item
has similarity 0 in both metrics and contributes nothing to a prediction, so
its absence loses nothing; statistics that count such pairs add them back
arithmetically (see ``kinship.operators.stats``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, SIM_DIGITS, RatingScale, safe_ratio, tidy
from kinship.operators.blocks import block_pairs, block_plan
from kinship.operators.features import preprocess, user_table
from kinship.operators.packed import ordered_rows
from kinship.operators.skew import DEFAULT_SKEW, JoinPlan, SkewPolicy, plan_join, salted_join

METRICS = ("cosine", "jaccard")


def _check_metric(metric: str) -> str:
    m = metric.lower()
    aliases = {"adjustedcosine": "cosine", "adjusted_cosine": "cosine"}
    m = aliases.get(m, m)
    if m not in METRICS:
        raise ValueError(f"unknown similarity metric {metric!r}; use one of {METRICS}")
    return m


def pair_input(ratings: DataFrame, metric: str | None = None, bounds: RatingScale = DEFAULT_SCALE,
               users: DataFrame | None = None) -> DataFrame:
    """The least that pairs of users need: ``(user, item)`` for overlaps, with
    ``n_ratings`` for Jaccard, with ``ndev`` for cosine. ``users``: the user table, if it
    is already there."""
    if metric is None:
        return ratings.select("user", "item")
    if _check_metric(metric) == "jaccard":
        users = user_table(ratings, False) if users is None else users
        return ratings.select("user", "item").join(users.select("user", "n_ratings"), "user")
    return preprocess(ratings, bounds, users).select("user", "item", "ndev")


def needs_norms(metric: str) -> bool:
    return _check_metric(metric) == "cosine"


def pair_sums(columns: Sequence[str], counted: Column | None = None) -> list[Column]:
    """What ``co_ratings`` sums of the rows of a pair; ``counted``: 1 for the rows of a common item."""
    sums = [(F.count(F.lit(1)) if counted is None else F.sum(counted)).alias("overlap")]
    if "ndev" in columns:
        sums.append(F.sum("product").alias("dot"))
    if "n_ratings" in columns:
        sums += [F.max("n_ratings_u").alias("n_user"), F.max("n_ratings_v").alias("n_neighbour")]
    return sums


def co_ratings(pre: DataFrame, hot: JoinPlan | None = None, for_users: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """``(user, neighbour, overlap[, dot][, n_user, n_neighbour])`` for every pair of
    users with at least one common item; ``dot`` if ``pre`` has ``ndev``, the counts if
    it has ``n_ratings``.

    Without ``for_users`` each unordered pair appears once, as ``user >
    neighbour`` (lower triangle). With ``for_users`` (a DataFrame with a ``user``
    column) only those users are on the left and pairs are ordered: ``(u, v)``
    for every ``v != u``. ``dot`` sums ``ndev_u * ndev_v`` over common items.
    ``ordered`` gives ordered pairs of all users.

    A join that needs more than one task's pairs deals them out by its own partition count
    before they are summed: unordered pairs by both users, ordered ones of all users by the left
    user (cut into ``hot.cells`` by the neighbour), whose ranks then need no further shuffle; those
    travel as lists (``kinship.operators.packed``). A sum on the map side would hold nearly
    one row per pair there and merge few of them.
    """
    if ordered and for_users is None and hot is not None and hot.partitions:
        rows, pair = ordered_rows(pre, hot)
        return rows.groupBy(*pair).agg(*pair_sums(pre.columns)).drop("_cell")
    extra = [c for c in ("ndev", "n_ratings") if c in pre.columns]
    if for_users is None and hot is not None and hot.partitions and hot.buckets is None:
        # both sides are dealt out alike, so one shuffle gives both
        pre = pre.select("user", "item", *extra).repartition(hot.partitions, "item")
        hot = replace(hot, dealt=True)
    left = pre.select("user", "item", *[F.col(c).alias(f"{c}_u") for c in extra])
    right = pre.select(F.col("user").alias("neighbour"), "item", *[F.col(c).alias(f"{c}_v") for c in extra])
    if for_users is not None:
        left = left.join(for_users.select("user").distinct(), "user", "left_semi")
    ordered = ordered or for_users is not None
    keep = F.col("user") != F.col("neighbour") if ordered else F.col("user") > F.col("neighbour")
    pairs = salted_join(left, right, "item", hot, "user", "neighbour").where(keep)
    values, sums = [], pair_sums(extra)
    if "ndev" in extra:
        values.append((F.col("ndev_u") * F.col("ndev_v")).alias("product"))
    if "n_ratings" in extra:
        values += ["n_ratings_u", "n_ratings_v"]
    pairs = pairs.select("user", *values, "neighbour")  # a value before an id: the id's leading zeros join the next row's header when compressed
    if hot is None or not hot.partitions:
        return pairs.groupBy("user", "neighbour").agg(*sums)
    if not ordered:
        return pairs.repartition(hot.partitions, "user", "neighbour").groupBy("user", "neighbour").agg(*sums)
    if hot.cells == 1:
        return pairs.repartition(hot.partitions, "user").groupBy("user", "neighbour").agg(*sums)
    cell = F.pmod(F.xxhash64("neighbour"), F.lit(hot.cells)).alias("_cell")
    return pairs.select("*", cell).repartition(hot.partitions, "user", "_cell").groupBy("user", "_cell", "neighbour").agg(*sums).drop("_cell")


def all_pairs(ratings: DataFrame, metrics: Sequence[str] = (), bounds: RatingScale = DEFAULT_SCALE, skew: SkewPolicy = DEFAULT_SKEW,
              users: DataFrame | None = None) -> DataFrame:
    """``co_ratings`` of all users of ``ratings`` with what ``metrics`` need, each pair once: by blocks of users where
    that suits (``kinship.operators.blocks``). ``users``: the user table, if it is already there."""
    wanted = [c for m, c in (("cosine", "ndev"), ("jaccard", "n_ratings")) if m in map(_check_metric, metrics)]
    plan = plan_join(ratings, ratings, "item", skew, deal="user")
    blocks = block_plan(ratings, plan)
    if users is None and (wanted or blocks):
        users = user_table(ratings, "ndev" in wanted, bounds)
    if blocks is not None:
        return block_pairs(ratings, users, blocks, wanted, bounds)
    if len(wanted) == 2:
        return co_ratings(preprocess(ratings, bounds, users), plan)
    return co_ratings(pair_input(ratings, metrics[0] if wanted else None, bounds, users), plan)


def similarity_value(metric: str):
    """Column computing the (rounded) similarity from a ``co_ratings`` row."""
    m = _check_metric(metric)
    if m == "cosine":
        raw = F.col("dot")
    else:
        union = F.col("n_user") + F.col("n_neighbour") - F.col("overlap")
        raw = safe_ratio(F.col("overlap").cast("double"), union.cast("double"))
    return tidy(raw, SIM_DIGITS)


def similarity_from_pairs(co: DataFrame, metric: str, keep_overlap: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Non-zero ``(user, neighbour, sim)`` and the columns ``also`` from an existing ``co_ratings`` table."""
    cols = ["user", "neighbour", similarity_value(metric).alias("sim"), *also]
    if keep_overlap:
        cols.append("overlap")
    return co.select(*cols).where(F.col("sim") != 0.0)


def similarity(
    pre: DataFrame,
    metric: str = "cosine",
    hot: JoinPlan | None = None,
    for_users: DataFrame | None = None,
    keep_overlap: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Non-zero similarities ``(user, neighbour, sim)``; lower triangle unless
    ``for_users`` or ``ordered`` is given (see ``co_ratings``)."""
    return similarity_from_pairs(co_ratings(pre, hot, for_users, ordered), metric, keep_overlap)
