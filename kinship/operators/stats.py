"""Statistics over all user pairs, with the zero pairs added arithmetically.

The pair tables hold non-zero rows only. Of ``P`` pairs in total the table holds
``n``, with mean ``m`` and centred sum of squares ``M`` (merged from the partitions
as they are, never as a difference of large sums). The ``P - n`` zeros are one more
part with mean 0 and no spread: ``mean = n m / P`` and, by the rule that merges two
parts, variance ``(M + m^2 n (P - n) / P) / P``; 0 joins the min/max whenever ``n < P``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import safe_ratio
from kinship.operators.features import half_square

# Fixed value: bytes stored per similarity (one double).
BYTES_PER_SIMILARITY = 8


def summary_with_zeros(values: DataFrame, col: str, n_total: Column, more: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """One row ``(n_total, n_nonzero, min_value, max_value, mean_value, stddev_value)``
    over ``n_total`` values, of which the rows of ``values`` are the non-zero ones.
    ``more``: further named aggregates of the same rows."""
    x = F.col(col).cast("double")
    agg = values.agg(
        F.count(x).alias("_n"),
        F.avg(x).alias("_m"),
        F.var_pop(x).alias("_v"),
        F.min(x).alias("_mn"),
        F.max(x).alias("_mx"),
        *[value.alias(name) for name, value in more],
    )
    p = n_total.cast("long")
    n, total = F.col("_n").cast("double"), p.cast("double")
    m = F.coalesce(F.col("_m"), F.lit(0.0))
    share = safe_ratio(n, total)
    mean = share * m
    # n / P times the variance of the rows, plus the spread between the rows and the zeros
    var = share * F.coalesce(F.col("_v"), F.lit(0.0)) + share * (F.lit(1.0) - share) * m * m
    has_zero = F.col("_n") < p
    return agg.select(
        p.alias("n_total"),
        F.col("_n").alias("n_nonzero"),
        F.when(has_zero, F.least(F.col("_mn"), F.lit(0.0))).otherwise(F.col("_mn")).alias("min_value"),
        F.when(has_zero, F.greatest(F.col("_mx"), F.lit(0.0))).otherwise(F.col("_mx")).alias("max_value"),
        mean.alias("mean_value"),
        F.sqrt(var).alias("stddev_value"),
        *[name for name, _ in more],
    )


def multiplications_total(ratings: DataFrame) -> DataFrame:
    """One row: ``multiplications``, the number of products summed over all
    pairs (the total size of all item intersections). An item with ``n`` raters is
    in ``n (n - 1) / 2`` intersections, so one count per item gives it; ratings are
    unique per (user, item)."""
    per_item = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return per_item.agg(F.coalesce(F.sum(half_square("n")), F.lit(0)).cast("long").alias("multiplications"))


def nonzero_bytes(sims: DataFrame) -> DataFrame:
    """One row ``(nonzero, bytes)`` for a table of non-zero similarities."""
    n = F.count(F.lit(1)).cast("long")
    return sims.agg(n.alias("nonzero"), (n * F.lit(BYTES_PER_SIMILARITY)).alias("bytes"))


def nonzero_bytes_of(col: str) -> Column:
    """The ``bytes`` of ``nonzero_bytes`` for one of several similarities in a table, as an aggregate."""
    return F.count_if(F.col(col) != 0.0) * F.lit(BYTES_PER_SIMILARITY)


def knn_bytes(ratings: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(k, bytes)``: storage of a ``k``-nearest table, ``N * min(k, N - 1) * 8``
    bytes for ``N`` distinct users (LONG, no overflow)."""
    n = F.col("n_users").cast("long")
    k = F.explode(F.array(*[F.lit(int(v)) for v in ks])).alias("k")
    return (
        ratings.agg(F.count_distinct("user").alias("n_users"))
        .select("n_users", k)
        .select("k", (n * F.least(F.col("k").cast("long"), n - F.lit(1)) * F.lit(BYTES_PER_SIMILARITY)).alias("bytes"))
    )
