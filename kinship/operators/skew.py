"""Bounded work per task for joins whose output grows with the square of a key.

An item with ``n`` left and ``m`` right rows emits ``n * m`` pairs, while its input
bytes grow like ``n + m``; byte-based skew detection does not see it. Two things
bound the pairs of a task:

* keys are cut into ``ceil(n / bucket_rows)`` left and ``ceil(m / bucket_rows)`` right
  buckets by a hash of the other column; rows are copied once per bucket of the
  other side only, so a side that is small is never the reason to copy the large
  one. Every pair meets exactly once, in a cell of at most about
  ``bucket_rows ** 2`` pairs;
* a join of more than ``pairs_per_task`` pairs gets a partition count from the number
  of pairs, and both sides are dealt out by cell, so that partitions are not merged by
  their (few) bytes. ``co_ratings`` deals the pairs themselves into as many partitions,
  so that neither side of that shuffle holds more of them than memory has room for.

The bucket counts are written once, by the one job that counts both sides. Where they
are too many to broadcast, rows and counts meet in a join of two plain shuffles, and
AQE cuts the rows of a hot key before they are given their buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinship.session import write_table

_A = "_salt_a"  # bucket of the left row
_B = "_salt_b"  # bucket of the right row


@dataclass(frozen=True)
class SkewPolicy:
    """``bucket_rows``: most rows of one key and side in a bucket (None: no buckets).
    ``pairs_per_task``: pairs that one task may emit before partitions are added.
    ``max_partitions``: no join gets more of them (each costs the driver memory); past it a
    task emits more pairs."""

    bucket_rows: int | None = 2_000
    pairs_per_task: int = 4_000_000
    max_partitions: int = 50_000


DEFAULT_SKEW = SkewPolicy()


@dataclass(frozen=True)
class JoinPlan:
    """``buckets``: (key, _left, _right) bucket counts of the keys that are cut, or None.
    ``partitions``: partitions of the join, or None for Spark's own.
    ``wide``: (key) the keys with more right rows than asked for, or None if there are none.
    ``cells``: parts of one left user's pairs that keep each of them within a task's pairs.
    ``spare``: users with whom any given user is sure to share no key (None: not known).
    ``dealt``: both sides already stand in ``partitions`` by the key.
    ``pairs``: joined pairs; ``rows``: left rows; ``owners``: distinct left values of ``deal``;
    ``reach``: the most pairs that one of those can have."""

    buckets: DataFrame | None
    partitions: int | None
    wide: DataFrame | None = None
    cells: int = 1
    spare: int | None = None
    dealt: bool = False
    pairs: int = 0
    rows: int = 0
    owners: int = 0
    reach: int = 0


def plan_join(left: DataFrame, right: DataFrame, key: str, policy: SkewPolicy = DEFAULT_SKEW, wide: int | None = None,
              deal: str | None = None) -> JoinPlan:
    """Counts both sides per key in one job, which also writes the keys that are cut and
    those with more than ``wide`` right rows; a few numbers reach the driver. Nothing
    forces a broadcast: the written tables are joined by whatever their sizes allow.
    ``deal``: the left column by which the pairs are to be dealt out; its most frequent
    value, times the right rows of the largest key, bounds the pairs of one value."""
    if policy.bucket_rows is None and wide is None:
        return JoinPlan(None, None)
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if left is right:
        n = count(left, "_n").select(key, "_n", F.col("_n").alias("_m"))
    else:
        n = count(left, "_n").join(count(right, "_m"), key)
    limit = int(policy.bucket_rows or 0)
    hot = (F.col("_n") > limit) | (F.col("_m") > limit) if limit else F.lit(False)
    broad = F.col("_m") > wide if wide is not None else F.lit(False)
    buckets = lambda c: F.ceil(F.col(c) / F.lit(limit or 1)).cast("int")
    seen = Observation()
    counted = n.withColumn("_hot", hot).withColumn("_wide", broad).withColumn("_own", F.lit(None).cast("long"))
    if deal is not None:
        own = left.where(F.col(deal).isNotNull()).groupBy(deal).agg(F.count(F.lit(1)).alias("_own")).select("_own")
        counted = counted.unionByName(own, allowMissingColumns=True)
    watched = counted.observe(
        seen, F.sum(F.col("_n").cast("double") * F.col("_m")).alias("pairs"), F.sum("_n").alias("rows"), F.max("_m").alias("most"),
        F.max("_own").alias("own"), F.count("_own").alias("owners"), F.count_if("_hot").alias("hot"), F.count_if("_wide").alias("wide"))
    noted = write_table(watched.where("_hot or _wide").select(
        key, buckets("_n").alias("_left"), buckets("_m").alias("_right"), "_hot", "_wide"), "key-counts")
    found = seen.get
    wanted = min(math.ceil((found.get("pairs") or 0) / policy.pairs_per_task), policy.max_partitions)
    reach = (found.get("own") or 0) * (found.get("most") or 0)
    return JoinPlan(
        noted.where("_hot").select(key, "_left", "_right") if found.get("hot") else None,
        wanted if limit and wanted > 1 else None,
        noted.where("_wide").select(key) if found.get("wide") else None,
        max(1, min(math.ceil(reach / policy.pairs_per_task), wanted)),
        found["owners"] - 1 - reach if deal is not None and left is right else None,
        pairs=int(found.get("pairs") or 0), rows=found.get("rows") or 0, owners=found.get("owners") or 0, reach=reach)


def _cut(df: DataFrame, key: str, plan: JoinPlan, salt_col: str, own: str, other: str, own_n: str, other_n: str) -> DataFrame:
    if plan.buckets is None:
        return df
    n = lambda c: F.coalesce(F.col(c), F.lit(1))
    return (
        df.join(plan.buckets, key, "left")
        .withColumn(own, F.pmod(F.xxhash64(salt_col), n(own_n).cast("long")).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), n(other_n) - F.lit(1))))
        .drop("_left", "_right")
    )


def salted_join(left: DataFrame, right: DataFrame, key: str, plan: JoinPlan | None, left_salt: str, right_salt: str) -> DataFrame:
    """Inner equi-join of ``left`` and ``right`` on ``key`` by ``plan``; ``left_salt`` and
    ``right_salt`` are columns that spread a key's rows."""
    if plan is None:
        return left.join(right, key)
    lhs = _cut(left, key, plan, left_salt, _A, _B, "_left", "_right")
    rhs = _cut(right, key, plan, right_salt, _B, _A, "_right", "_left")
    on = [key] if plan.buckets is None else [key, _A, _B]
    if plan.partitions and not plan.dealt:
        lhs, rhs = lhs.repartition(plan.partitions, *on), rhs.repartition(plan.partitions, *on)
    return lhs.join(rhs, on).drop(_A, _B)


def listed_sides(left: DataFrame, right: DataFrame, key: str, plan: JoinPlan, salt: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides cut and dealt out as ``salted_join`` would, and the columns of a cell."""
    lhs = _cut(left, key, plan, salt, _A, _B, "_left", "_right")
    rhs = _cut(right, key, plan, salt, _B, _A, "_right", "_left")
    on = [key] if plan.buckets is None else [key, _A, _B]
    if plan.partitions:
        lhs, rhs = lhs.repartition(plan.partitions, *on), rhs.repartition(plan.partitions, *on)
    return lhs, rhs, on


def with_list(rows: DataFrame, others: DataFrame, on: Sequence[str], entry: Column) -> DataFrame:
    """``rows``, each with the sorted ``entry`` values of the other side's rows in its cell: at most
    about ``bucket_rows`` of them, which travel as one row where a join would make a row each."""
    return rows.join(others.groupBy(*on).agg(F.sort_array(F.collect_list(entry)).alias("list")), list(on))
