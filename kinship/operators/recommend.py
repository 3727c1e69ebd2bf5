"""Recommendations for a new user who rated part of a personal list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, PRED_DIGITS, RatingScale, tidy
from kinship.operators.predict import predict, predict_per_k
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy
from kinship.sources.tables import PERSONAL_USER


def personal_train(personal: DataFrame, user: int = PERSONAL_USER) -> DataFrame:
    """Rated rows of the personal list as ratings of ``user``."""
    return personal.where(F.col("rating").isNotNull()).select(
        F.lit(user).cast("long").alias("user"), F.col("item").cast("long").alias("item"), F.col("rating")
    )


def personal_targets(personal: DataFrame, user: int = PERSONAL_USER) -> DataFrame:
    """Unrated rows of the personal list: the items to predict for ``user``."""
    return personal.where(F.col("rating").isNull()).select(
        F.lit(user).cast("long").alias("user"), F.col("item").cast("long").alias("item"), F.col("rating")
    )


def train_with_personal(ratings: DataFrame, personal: DataFrame, user: int = PERSONAL_USER) -> DataFrame:
    """All ratings plus the personal user's (bag union, no shuffle)."""
    return ratings.select("user", "item", "rating").unionByName(personal_train(personal, user))


def top_n(predictions: DataFrame, titles: DataFrame, n: int | None = 5) -> DataFrame:
    """``(item, title, prediction)``: the ``n`` best titled predictions, ties to
    the smaller item id; all of them, unordered, if ``n`` is None. Predictions are rounded to 6 decimals before ordering,
    so equal values are equal in every engine; ``orderBy + limit`` plans as one
    bounded TakeOrderedAndProject (each task keeps ``n`` rows)."""
    ranked = predictions.select("item", tidy("prediction", PRED_DIGITS).alias("prediction"))
    titled = ranked.join(titles.select("item", "title"), "item").select("item", "title", "prediction")
    return titled if n is None else titled.orderBy(F.desc("prediction"), F.asc("item")).limit(n)


def recommend(
    ratings: DataFrame,
    personal: DataFrame,
    k: int,
    n: int | None = 5,
    user: int = PERSONAL_USER,
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Top ``n`` unrated personal items for ``user`` with ``k`` neighbours.

    Similarities are computed for the personal user only (ordered pairs from
    that user), not for the whole user triangle.
    """
    train = train_with_personal(ratings, personal, user)
    targets = personal_targets(personal, user)
    preds = predict(train, targets, metric, k, bounds, skew, only_target_users=True)
    return top_n(preds, personal, n)


def recommend_per_k(
    ratings: DataFrame,
    personal: DataFrame,
    ks: Sequence[int],
    n: int = 5,
    user: int = PERSONAL_USER,
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """``(k, position, item, title, prediction)``: what ``recommend`` gives for every ``k`` (all > 0),
    from one ranking of the neighbours up to the largest ``k``. Each task passes on at
    most ``n`` rows a ``k``."""
    train = train_with_personal(ratings, personal, user)
    preds = predict_per_k(train, personal_targets(personal, user), ks, metric, bounds, skew, only_target_users=True)
    titled = preds.select("k", "item", tidy("prediction", PRED_DIGITS).alias("prediction")).join(personal.select("item", "title"), "item")
    position = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("prediction"), F.asc("item")))
    return titled.withColumn("position", position).where(F.col("position") <= n).select("k", "position", "item", "title", "prediction")
