"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.session import write_table

ROWS_PER_TASK = 250_000  # link tables are narrow: this many rows keep a task busy


def _tasks(rows: int) -> int:
    return 1 + rows // ROWS_PER_TASK


def _star(pairs: DataFrame, small: bool, tasks: int) -> DataFrame:
    """``pairs``: (a, b). Every ``a`` connects its partners to the smallest of them and
    itself. The minima are written, so that a hub with very many partners can be split."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    least = write_table(least.coalesce(tasks), "minima")
    joined = pairs.join(least, "a")
    moved = joined.where("b <> m" if small else "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        moved = moved.union(least.where("a <> m").select("a", F.col("m").alias("b")))
    return write_table(moved.distinct().coalesce(tasks), "links")


def _all_stars(edges: DataFrame) -> bool:
    """Every id has one parent at most, and no parent has one."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    odd = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
    return not odd.coalesce(1).head(1)


def components(links: DataFrame) -> DataFrame:
    """``links``: (a, b), long, any direction; repeated links, loops and nulls do no
    harm. Returns ``(id, component)`` for every id with a link: the smallest id that it
    can reach. The number of rounds grows with the logarithm of the longest path; each
    round's links are written to the shared folder, so a lost executor costs a re-read."""
    edges = write_table(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _all_stars(edges):
        tasks = _tasks(2 * edges.count())
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        edges = _star(_star(both, False, tasks), True, tasks)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
