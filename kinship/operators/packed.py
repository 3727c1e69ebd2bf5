"""Ordered pairs of users, sent as lists: a shuffled row holds one rating of a user and all
raters of its item, so that every pair meets in the task of its left user.

The raters' ids stand in planes of 16, 8 and the remaining bits, each left out where all of
its bits are zero; a value of a rater is a double as it is, a count stands in planes too.
So an ordered pair costs the 2 or 3 bytes that tell its ids apart and its value, where a
row a pair repeats the left user and his value. Any long can be an id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.operators.skew import JoinPlan, listed_sides

_LOW, _MID = 16, 8  # bits of the first two planes


def _signed(bits: Column, width: int, kind: str) -> Column:
    """The lowest ``width`` bits as a signed number of that width."""
    half = F.lit(1 << (width - 1)).cast("long")
    return (bits.bitwiseAND(F.lit((1 << width) - 1).cast("long")).bitwiseXOR(half) - half).cast(kind)


def planes(longs: str, bits: str, name: str) -> list[Column]:
    """The planes of an array of longs; ``bits``: their bitwise or."""
    rest = F.shiftright(bits, _LOW).bitwiseAND(F.lit((1 << _MID) - 1).cast("long")) != 0
    return [
        F.transform(longs, lambda x: _signed(x, _LOW, "smallint")).alias(f"{name}_low"),
        F.when(rest, F.transform(longs, lambda x: _signed(F.shiftright(x, _LOW), _MID, "tinyint"))).alias(f"{name}_mid"),
        F.when(F.shiftright(bits, _LOW + _MID) != 0, F.transform(longs, lambda x: F.shiftright(x, _LOW + _MID))).alias(f"{name}_top"),
    ]


def plane_value(name: str, place: str) -> Column:
    """The long at ``place`` of the planes ``name``."""
    at = lambda plane: F.coalesce(F.get(f"{name}_{plane}", F.col(place)).cast("long"), F.lit(0).cast("long"))
    low = at("low").bitwiseAND(F.lit((1 << _LOW) - 1).cast("long"))
    mid = F.shiftleft(at("mid").bitwiseAND(F.lit((1 << _MID) - 1).cast("long")), _LOW)
    return low.bitwiseOR(mid).bitwiseOR(F.shiftleft(at("top"), _LOW + _MID))


def _lists(others: DataFrame, on: Sequence[str], value: str | None, count: str | None) -> DataFrame:
    """One row per cell of the join: the planes of its users, sorted, and their values or counts."""
    entry = F.struct("user", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) if c == count else F.col(c) for c in (value, count) if c])
    found = others.groupBy(*on).agg(
        F.sort_array(F.collect_list(entry)).alias("_l"), F.bit_or("user").alias("_bits"),
        *([F.bit_or(count).alias("_count_bits")] if count else []))
    return found.select(
        *on, *planes("_l.user", "_bits", "_v"),
        *([F.col(f"_l.{value}").alias("_values")] if value else []),
        *(planes(f"_l.{count}", "_count_bits", "_n") if count else []))


def _met(rows: DataFrame, others: DataFrame, plan: JoinPlan | None, cells: int, value: str | None, count: str | None) -> DataFrame:
    """``rows``, each with the lists of its item; a list for each of ``cells`` parts of the raters."""
    plan = JoinPlan(None, None) if plan is None else plan
    rows, others, on = listed_sides(rows.where("user is not null"), others.where("user is not null"), "item", plan, "user")
    cell = []
    if cells > 1:
        cell = ["_cell"]
        others = others.withColumn("_cell", F.pmod(F.xxhash64("user"), F.lit(cells)))
    return rows.join(_lists(others, [*on, *cell], value, count), on).drop("_salt_a", "_salt_b")


def ordered_rows(pre: DataFrame, plan: JoinPlan, asked: DataFrame | None = None, dev: DataFrame | None = None,
                 asked_plan: JoinPlan | None = None) -> tuple[DataFrame, list[str]]:
    """The rows of the ordered pairs ``(user, neighbour)`` that share an item, in the task of the user
    (and of a part of his neighbours with ``plan.cells``), and the columns that group them:
    ``product`` of both ``ndev`` and the ``n_ratings`` of both where ``pre`` has them. With ``asked``
    targets ``(user, item)`` also a row of each target and rater of its item, with ``item`` and the rater's
    ``dev``; ``shared`` is 1 for the former and 0 for the latter."""
    value = "ndev" if "ndev" in pre.columns else None
    count = "n_ratings" if "n_ratings" in pre.columns else None
    own = [c for c in (value, count) if c]
    pre = pre.select("user", "item", *own)
    rows = _met(pre, pre, plan, plan.cells, value, count).withColumn("shared", F.lit(1))
    partitions = plan.partitions
    if asked is None:
        rows = rows.drop("item")
    else:
        wanted = _met(asked.select("user", "item"), dev.select("user", "item", "dev"), asked_plan, plan.cells, "dev", None)
        rows = rows.withColumn("item", F.lit(None).cast(dict(asked.dtypes)["item"])).unionByName(
            wanted.withColumn("shared", F.lit(0)), allowMissingColumns=True)
        partitions = (plan.partitions or 0) + ((asked_plan.partitions if asked_plan else None) or 0) or None
    keys = ["user", "_cell"] if plan.cells > 1 else ["user"]
    rows = rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)
    at = F.get("_values", F.col("_place")) if "_values" in rows.columns else None
    each = rows.select("*", F.posexplode("_v_low").alias("_place", "_one"))
    out = [*keys, plane_value("_v", "_place").alias("neighbour")]
    if value:
        out.append((F.col("ndev") * at).alias("product"))
    if count:
        out += [F.col("n_ratings").alias("n_ratings_u"), plane_value("_n", "_place").alias("n_ratings_v")]
    if asked is not None:
        out += ["shared", "item", at.alias("dev")]
    return each.select(*out).where(F.col("user") != F.col("neighbour")), [*keys, "neighbour"]
