"""Rating views derived from the driver's TPC-H-like parquet tables.

No table holds ratings, so a customer's purchases stand in for them:
``user = o_custkey``, ``item = l_partkey`` and the rating is the quantity band
(1-10 -> 1, ..., 41-50 -> 5), the highest band when a customer bought a part
more than once, which keeps (user, item) unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived views.
PERSONAL_USER = -1          # id of the "new user" of the recommender (real ids start at 0)
SPLIT_USER_FACTOR = 7       # a rating is a target when (7*user + 13*item) % 5 == 0
SPLIT_ITEM_FACTOR = 13
SPLIT_MODULUS = 5
HELD_OUT_MODULUS = 37       # the item split also makes targets of all ratings of items with item % 37 == 0
PERSONAL_RATED_MODULUS = 7  # part rated by the personal user when p_partkey % 7 == 3,
PERSONAL_RATED_REMAINDER = 3  # with rating 1 + p_partkey % 5
PERSONAL_RATING_MODULUS = 5


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings(user LONG, item LONG, rating DOUBLE)``, unique per (user, item)."""
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    band = F.lit(1) + F.floor((F.col("l_quantity") - F.lit(1)) / F.lit(10)).cast("int")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.max(band).cast("double").alias("rating"))
    )


def is_target(user: str = "user", item: str = "item"):
    key = F.col(user) * SPLIT_USER_FACTOR + F.col(item) * SPLIT_ITEM_FACTOR
    return (key % SPLIT_MODULUS) == 0


def split_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deterministic ~80/20 train/target split; a pure row filter, no shuffle."""
    return ratings.where(~is_target()), ratings.where(is_target())


def split_holding_out_items(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The train/target split with real cold items: besides the usual targets, every
    rating of a held-out item is a target, so that train never sees those items."""
    target = is_target() | (F.col("item") % HELD_OUT_MODULUS == 0)
    return ratings.where(~target), ratings.where(target)


def personal_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``personal(item LONG, title STRING, rating DOUBLE NULL)`` from ``part``."""
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    rated = (F.col("p_partkey") % PERSONAL_RATED_MODULUS) == PERSONAL_RATED_REMAINDER
    value = (F.lit(1) + F.col("p_partkey") % PERSONAL_RATING_MODULUS).cast("double")
    return part.select(
        F.col("p_partkey").alias("item"),
        F.col("p_name").alias("title"),
        F.when(rated, value).alias("rating"),
    )
