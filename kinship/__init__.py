"""kinship: user-based neighbourhood recommendation on Spark DataFrames.

Everything is a DataFrame in, DataFrame out function; the heavy work (co-rating
pairs, neighbour ranks, weighted deviations) is expressed with joins, grouped
aggregates and windows so that Catalyst and AQE plan it for the cluster.
"""

from kinship.functions.columns import RatingScale
from kinship.operators.features import (
    feature_avg,
    global_avg,
    item_avg,
    normalized_deviation,
    pair_count,
    preprocess,
    user_avg,
    user_count,
    user_norm,
)
from kinship.operators.neighbors import directed, neighbors
from kinship.operators.predict import predict, weighted_deviation
from kinship.operators.similarity import co_ratings, similarity
from kinship.operators.evaluate import k_sweep, lowest_k, mae

__all__ = [
    "RatingScale",
    "co_ratings",
    "directed",
    "feature_avg",
    "global_avg",
    "item_avg",
    "k_sweep",
    "lowest_k",
    "mae",
    "neighbors",
    "normalized_deviation",
    "pair_count",
    "predict",
    "preprocess",
    "similarity",
    "user_avg",
    "user_count",
    "user_norm",
    "weighted_deviation",
]
