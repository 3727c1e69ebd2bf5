"""Weighted sums of all users' predictions, with pairs of users sent as lists.

A prediction over all users needs the similarity of a target's user and a rater of its
item only where both also share a train item. So neither side of that match carries a
value that is computed from a user's mean or norm: the pairs travel as the user, the
rating's code and the list of the item's other raters, each one number that holds the
rater and the code of that rating; the candidates travel alike, by the same user (the
larger id of the two). Rows of a pair meet in one task, the pairs that are on one side
only are dropped there, and what is left reads the users' means and norms.

Codes number the distinct ratings of the train set. A scale of more than ``MAX_STEPS``
ratings, or ids too large to share a number with a code, go the way of ``co_ratings``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.functions.columns import SIM_DIGITS, RatingScale, deviation, safe_ratio, tidy
from kinship.operators.skew import JoinPlan, SkewPolicy, listed_sides, plan_join, with_list

MAX_STEPS = 256
_LARGEST = 2**62


@dataclass(frozen=True)
class Codes:
    """``levels``: the distinct ratings (None among them if there is one), by their code."""

    levels: tuple[float | None, ...]

    def of(self, rating: str) -> Column:
        code = F.lit(None).cast("long")
        for n, level in enumerate(self.levels):
            code = F.when(F.col(rating).eqNullSafe(F.lit(level)), F.lit(n).cast("long")).otherwise(code)
        return code

    def rating(self, code: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("double") for v in self.levels]), (code + F.lit(1)).cast("int"))

    def pack(self, user: str, code: Column) -> Column:
        return F.col(user).cast("long") * F.lit(len(self.levels)) + code

    def code(self, packed: Column) -> Column:
        return F.pmod(packed, F.lit(len(self.levels)).cast("long"))

    def user(self, packed: Column) -> Column:
        return F.call_function("div", packed - self.code(packed), F.lit(len(self.levels)).cast("long"))


def rating_codes(train: DataFrame, targets: DataFrame | None = None) -> Codes | None:
    """The codes of the train set's ratings, or None if they are too many or an id of a user is too
    large. One job; at most ``MAX_STEPS`` + 2 rows reach the driver."""
    ids = train.select("user", "rating", F.lit(True).alias("_own"))
    if targets is not None:
        ids = ids.unionByName(targets.select("user", F.lit(None).cast("double").alias("rating"), F.lit(False).alias("_own")))
    steps = ids.groupBy("_own", "rating").agg(F.min("user").alias("low"), F.max("user").alias("high")).limit(MAX_STEPS + 2).collect()
    levels = sorted((r.rating for r in steps if r._own), key=lambda v: (v is not None, v))
    largest = max((max(abs(r.low or 0), abs(r.high or 0)) for r in steps), default=0)
    if not levels or len(levels) > MAX_STEPS or (largest + 1) * len(levels) >= _LARGEST or any(v != v for v in levels):
        return None
    return Codes(tuple(levels))


def _dealt(rows: DataFrame, codes: Codes, plan: JoinPlan, partitions: int | None) -> DataFrame:
    """List rows dealt out by their user, in ``plan.cells`` parts by the list's users."""
    if plan.cells > 1:
        part = F.explode(F.sequence(F.lit(0), F.lit(plan.cells - 1))).alias("_cell")
        inside = F.filter("list", lambda x: F.pmod(F.xxhash64(codes.user(x)), F.lit(plan.cells)) == F.col("_cell"))
        rows = rows.select("*", part).withColumn("list", inside)
    keys = ["user", "_cell"] if plan.cells > 1 else ["user"]
    rows = rows.where(F.size("list") > 0)
    return rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)


def matched(train: DataFrame, targets: DataFrame, codes: Codes, skew: SkewPolicy, plan: JoinPlan) -> DataFrame:
    """``(user, neighbour, item, code, first, common)``: each target with each rater of its item
    that shares a train item with the target's user. ``user`` is the larger id of both and the
    target's user where ``first``; ``code`` is the rater's rating of ``item``, ``common`` holds
    the two ratings of every common item (``n_levels`` * the user's code + the neighbour's). ``plan``: of the
    join of ``train`` with itself."""
    hot = plan_join(targets, train, "item", skew)
    partitions = (plan.partitions or 0) + (hot.partitions or 0) or None
    if plan.partitions and plan.buckets is None and hot.buckets is None:
        hot = replace(hot, partitions=plan.partitions)  # the ratings are then dealt out by item once
    coded = train.select("user", "item", codes.of("rating").alias("code")).where("user is not null")
    wanted = targets.select("user", "item").where("user is not null")
    known = lambda rows: rows.withColumn("list", F.filter("list", lambda x: codes.user(x) < F.col("user")))
    mine, others, on = listed_sides(coded, coded, "item", plan, "user")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    entry, plain = codes.pack("user", F.col("code")), codes.pack("user", zero)
    shared = with_list(mine, others, on, entry).select("user", F.lit(0).alias("kind"), none.alias("item"), "code", "list")
    asked, raters, on = listed_sides(wanted, coded, "item", hot, "user")
    item = F.col("item").cast("long")
    targets_first = with_list(asked, raters, on, entry).select("user", F.lit(1).alias("kind"), item.alias("item"), zero.alias("code"), "list")
    raters_first = with_list(raters, asked, on, plain).select("user", F.lit(2).alias("kind"), item.alias("item"), "code", "list")
    rows = _dealt(known(shared.unionByName(targets_first).unionByName(raters_first)), codes, plan, partitions)
    cell = ["_cell"] if plan.cells > 1 else []
    flat = rows.select("user", *cell, "kind", "item", "code", F.explode("list").alias("_p")).select(
        "user", *cell, codes.user(F.col("_p")).alias("neighbour"), "kind", "item", "code", codes.code(F.col("_p")).alias("other"))
    pair = ["user", *cell, "neighbour"]
    own = Window.partitionBy(*pair)
    both = flat.withColumn("_least", F.min("kind").over(own)).withColumn("_most", F.max("kind").over(own)).where(
        (F.col("_least") == 0) & (F.col("_most") > 0))
    times = F.lit(len(codes.levels)).cast("long")
    met = both.groupBy(*pair).agg(
        F.collect_list(F.when(F.col("kind") == 0, F.col("code") * times + F.col("other"))).alias("common"),
        F.collect_list(F.when(F.col("kind") > 0, F.struct(
            "item", F.when(F.col("kind") == 1, F.col("other")).otherwise(F.col("code")).alias("code"),
            (F.col("kind") == 1).alias("first")))).alias("_asked"))
    return met.select("user", "neighbour", "common", F.explode("_asked").alias("a")).select(
        "user", "neighbour", "a.item", "a.code", "a.first", "common")


def similarity_of(metric: str, codes: Codes, bounds: RatingScale) -> Column:
    """The rounded similarity of a row of ``matched`` with both users' values (``_u`` and ``_v``)."""
    if metric == "jaccard":
        overlap = F.size("common")
        return tidy(safe_ratio(overlap.cast("double"), (F.col("n_ratings_u") + F.col("n_ratings_v") - overlap).cast("double")), SIM_DIGITS)
    steps = F.lit(len(codes.levels)).cast("long")
    unit = lambda code, side: safe_ratio(deviation(codes.rating(code), f"avg_rating_{side}", bounds), f"norm_{side}")
    product = lambda x: unit(F.call_function("div", x, steps), "u") * unit(F.pmod(x, steps), "v")
    return tidy(F.aggregate("common", F.lit(0.0), lambda total, x: total + product(x)), SIM_DIGITS)


def listed_sums(train: DataFrame, targets: DataFrame, users: DataFrame, metrics: Sequence[str], codes: Codes,
                bounds: RatingScale, skew: SkewPolicy, plan: JoinPlan) -> DataFrame:
    """``(user, item, num_<metric>, den_<metric>, ...)`` for the targets with a neighbour of non-zero
    similarity. Targets of unknown users have none and go no further than their ids."""
    known = targets.select("user", "item").join(users.select("user"), "user", "left_semi")
    rows = matched(train, known, codes, skew, plan)
    values = [c for c in ("avg_rating", "n_ratings", "norm") if c in users.columns]
    for key, side in (("user", "u"), ("neighbour", "v")):
        rows = rows.join(users.select(F.col("user").alias(key), *[F.col(c).alias(f"{c}_{side}") for c in values]), key)
    mean = F.when(F.col("first"), F.col("avg_rating_v")).otherwise(F.col("avg_rating_u"))
    rows = rows.select(
        F.when(F.col("first"), F.col("user")).otherwise(F.col("neighbour")).alias("user"), "item",
        codes.rating(F.col("code")).alias("rating"), mean.alias("mean"), *[similarity_of(m, codes, bounds).alias(m) for m in metrics])
    weighted = rows.withColumn("dev", deviation("rating", "mean", bounds)).where(" or ".join(f"{m} != 0.0" for m in metrics))
    return weighted.groupBy("user", "item").agg(*[
        f for m in metrics for f in (F.sum(F.col("dev") * F.col(m)).alias(f"num_{m}"), F.sum(F.abs(F.col(m))).alias(f"den_{m}"))])
