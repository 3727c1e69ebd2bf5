"""Per-user statistics and the preprocessing chain (mean -> deviation -> norm).

Per-user values are computed with grouped aggregates (partial aggregation on
the map side, so a user with a huge number of ratings costs one partial row
per map task), written once as the user table and joined back on ``user``. Spark
broadcasts that table when its file size is under the broadcast threshold and
shuffles both sides otherwise. Both sides are then plain shuffles, which AQE can
split where one user has very many ratings; it cannot split a side that is itself
an aggregate, and a window over the ratings of ``user`` would put all of them into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, RatingScale, deviation, safe_ratio
from kinship.session import write_table


def feature_avg(ratings: DataFrame, key: str) -> DataFrame:
    """Mean rating and rating count per ``key`` (``user`` or ``item``)."""
    return ratings.groupBy(key).agg(
        F.avg("rating").alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def user_avg(ratings: DataFrame) -> DataFrame:
    """``(user, avg_rating, n_ratings)``."""
    return feature_avg(ratings, "user")


def item_avg(ratings: DataFrame) -> DataFrame:
    """``(item, avg_rating, n_ratings)``."""
    return feature_avg(ratings, "item")


def global_avg(ratings: DataFrame) -> DataFrame:
    """One row: ``global_avg``, the mean of all ratings."""
    return ratings.agg(F.avg("rating").alias("global_avg"))


def global_avg_value(ratings: DataFrame) -> Column:
    """The global mean as a scalar-subquery column (evaluated once, lazily)."""
    return global_avg(ratings).scalar()


def user_count(ratings: DataFrame) -> DataFrame:
    """One row: ``n_users``, the exact number of distinct users."""
    return ratings.agg(F.count_distinct("user").alias("n_users"))


def user_count_value(ratings: DataFrame) -> Column:
    """Exact distinct-user count as a scalar-subquery column."""
    return user_count(ratings).scalar()


def pair_count(ratings: DataFrame) -> DataFrame:
    """One row: ``n_users`` and ``n_pairs = n_users * (n_users - 1) / 2`` (LONG)."""
    return user_count(ratings).select(F.col("n_users").cast("long").alias("n_users"), half_square("n_users").alias("n_pairs"))


def half_square(col: str) -> Column:
    """``n * (n - 1) / 2`` as an exact LONG (up to n = 4.29e9): the even factor is halved."""
    n = f"cast({col} as long)"
    return F.expr(f"if({n} % 2 = 0, ({n} div 2) * ({n} - 1), {n} * (({n} - 1) div 2))")


def user_table(ratings: DataFrame, norms: bool = True, bounds: RatingScale = DEFAULT_SCALE) -> DataFrame:
    """``(user, n_ratings, sum_rating, avg_rating[, norm])``, written once by one job; every branch
    of a plan that needs a user's values reads it. Equal ratings of a user are counted
    before they move, so a user costs as many rows as there are steps on the scale: few
    enough for a window over the user, which gives those rows the mean that the L2
    norm of the deviations needs."""
    counted = ratings.groupBy("user", "rating").agg(F.count(F.lit(1)).alias("times"))
    n, total = F.sum("times"), F.sum(F.col("rating") * F.col("times"))
    mean = F.col("sum_rating") / F.col("n_ratings")
    if not norms:
        sums = counted.groupBy("user").agg(n.alias("n_ratings"), total.alias("sum_rating"))
        return write_table(sums.withColumn("avg_rating", mean), "user-means")
    own = Window.partitionBy("user")
    rows = counted.select("user", "rating", "times", n.over(own).alias("n_ratings"), total.over(own).alias("sum_rating"))
    dev = rows.withColumn("avg_rating", mean).withColumn("dev", deviation("rating", "avg_rating", bounds))
    norm = F.sqrt(F.sum(F.col("times") * F.col("dev") * F.col("dev")))
    return write_table(dev.groupBy("user", "n_ratings", "sum_rating", "avg_rating").agg(norm.alias("norm")), "user-means")


def known_users(users: DataFrame) -> Column:
    """The number of users of a user table, as a scalar-subquery column."""
    return users.agg(F.count("user").alias("n_users")).scalar()


def overall_mean(users: DataFrame) -> Column:
    """The global mean rating from a user table, as a scalar-subquery column."""
    return users.agg(F.try_divide(F.sum("sum_rating"), F.sum("n_ratings")).alias("global_avg")).scalar()


def normalized_deviation(ratings: DataFrame, bounds: RatingScale = DEFAULT_SCALE, users: DataFrame | None = None) -> DataFrame:
    """``(user, item, rating, avg_rating, n_ratings, dev)``: each rating as a
    scale-normalised deviation from its user's mean. ``users``: the user table, if it
    is already there."""
    users = user_table(ratings, False) if users is None else users
    return ratings.select("user", "item", "rating").join(users.select("user", "avg_rating", "n_ratings"), "user").withColumn(
        "dev", deviation("rating", "avg_rating", bounds)
    )


def user_norm(deviations: DataFrame) -> DataFrame:
    """``(user, norm)``: L2 norm of a user's deviations."""
    return deviations.groupBy("user").agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm"))


def preprocess(ratings: DataFrame, bounds: RatingScale = DEFAULT_SCALE, users: DataFrame | None = None) -> DataFrame:
    """``(user, item, rating, avg_rating, n_ratings, dev, ndev)``.

    ``ndev`` is ``dev`` divided by the user's norm; a user whose ratings are all
    equal has norm 0 and gets ``ndev = 0`` (so similarity 0 with everyone).
    ``users``: the user table with norms, if it is already there. One join.
    """
    users = user_table(ratings, True, bounds) if users is None else users
    known = ratings.select("user", "item", "rating").join(users.select("user", "avg_rating", "n_ratings", "norm"), "user")
    return known.withColumn("dev", deviation("rating", "avg_rating", bounds)).withColumn(
        "ndev", safe_ratio("dev", "norm")).drop("norm")
