"""Neighbour tables: mirror the triangle, then rank per user for top-k.

Ranking follows the dense definition over *all* other users, where users that
share nothing with ``u`` have similarity 0 and rank between the positive and
the negative neighbours (ties: smaller neighbour id first). Zero rows are never
materialised. With ``neg`` the number of negative neighbours of ``u`` and ``N``
the number of users:

* a positive neighbour ranks ``row_number`` among the positives,
* the zero neighbours fill the ranks up to ``N - 1 - neg``,
* a negative neighbour ranks ``(N - 1 - neg) + row_number`` among the negatives,
  so only users with ``neg > N - 1 - k`` have any negative in their top ``k``;
  the negatives of all other users are dropped (by a per-user count, partially
  aggregated) before any sort.

Each window is filtered on ``row_number <= k`` right away, which lets Spark
insert a partial ``WindowGroupLimit`` before the shuffle: every map task sends
at most ``k`` rows per user, however many neighbours a user has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def directed(lower: DataFrame) -> DataFrame:
    """Both orientations of a lower-triangle table ``(user, neighbour, sim, ...)``.

    One ``explode`` per row instead of a ``union`` of two projections: the
    triangle (an aggregate) is then computed once, not once per orientation.
    """
    cols = [c for c in lower.columns if c not in ("user", "neighbour")]
    both = F.explode(
        F.array(
            F.struct(F.col("user").alias("a"), F.col("neighbour").alias("b")),
            F.struct(F.col("neighbour").alias("a"), F.col("user").alias("b")),
        )
    ).alias("_o")
    return lower.select(both, *cols).select(
        F.col("_o.a").alias("user"), F.col("_o.b").alias("neighbour"), *cols
    )


def ranked_all(sims: DataFrame, n_users: Column) -> DataFrame:
    """``(user, neighbour, sim, rank)`` for every non-zero neighbour. With ``nz`` of them a
    negative one ranks ``N - 1 - nz + row_number`` among all: the zero neighbours that it
    follows are the ones not listed."""
    own = Window.partitionBy("user")
    place = F.row_number().over(own.orderBy(F.desc("sim"), F.asc("neighbour"))).cast("long")
    zeros = n_users.cast("long") - F.lit(1) - F.col("_nz")
    return sims.select("user", "neighbour", "sim", place.alias("_place"), F.count(F.lit(1)).over(own).alias("_nz")).select(
        "user", "neighbour", "sim", (F.col("_place") + F.when(F.col("sim") < 0.0, zeros).otherwise(F.lit(0))).alias("rank"))


def neighbors(sims: DataFrame, k: int, n_users: Column, spare: int | None = None, also: Sequence[str] = ()) -> DataFrame:
    """``(user, neighbour, sim, rank)`` for the ``k`` nearest neighbours of each
    user, with the columns ``also``; ``sims`` holds both orientations of the non-zero similarities.

    ``k <= 0`` keeps every non-zero neighbour (rank NULL). ``n_users`` is the
    number of users ranked over (normally a scalar-subquery column). ``spare``: zero
    neighbours that every user is sure to have (``plan_join``); ``k`` of them leave no
    rank to a negative neighbour.
    """
    if k <= 0:
        return sims.withColumn("rank", F.lit(None).cast("long"))
    n = n_users.cast("long")
    order = Window.partitionBy("user").orderBy(F.desc("sim"), F.asc("neighbour"))
    rn = F.row_number().over(order)
    positives = (
        sims.where(F.col("sim") > 0.0)
        .select("user", "neighbour", "sim", *also)
        .withColumn("_rn", rn)
        .where(F.col("_rn") <= k)
        .select("user", "neighbour", "sim", F.col("_rn").cast("long").alias("rank"), *also)
    )
    if spare is not None and spare >= k:
        return positives
    negative = sims.where(F.col("sim") < 0.0).select("user", "neighbour", "sim", *also)
    reaching = (
        negative.groupBy("user")
        .agg(F.count(F.lit(1)).alias("_neg"))
        .where(F.col("_neg") > n - F.lit(1) - F.lit(k))
    )
    negatives = (
        negative.join(reaching, "user")
        .withColumn("_rn", rn)
        .where(F.col("_rn") <= k)
        .select("user", "neighbour", "sim", (n - F.lit(1) - F.col("_neg") + F.col("_rn")).alias("rank"), *also)
        .where(F.col("rank") <= k)
    )
    return positives.unionByName(negatives)
