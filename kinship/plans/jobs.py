"""The three end-to-end jobs: similarity answers, k-NN answers, recommendations.

Each reads its input files once, into checked tables bucketed by item in the shared
folder, computes its answers from those as a small DataFrame and optionally writes them as JSON. Row-count expectations are
parameters (the 100k MovieLens split has 80,000 / 20,000 / 100,000 / 1,682).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators.evaluate import BASELINE_MAE, REFERENCE_KS
from kinship.operators.recommend import recommend_per_k
from kinship.operators.reports import knn_report, similarity_report
from kinship.sources.files import ingest_personal, ingest_ratings
from kinship.sources.sinks import write_report

# Fixed values of the jobs' defaults.
RECOMMEND_KS = (30, 300)
TOP_N = 5
NEW_USER = 944


def similarity_job(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    json_path: str | None = None,
    train_rows: int | None = None,
    test_rows: int | None = None,
    baseline: float = BASELINE_MAE,
) -> DataFrame:
    """MAE of both metrics with all users, their differences, pair counts,
    overlap statistics and non-zero similarity bytes."""
    train = ingest_ratings(spark, train_path, train_rows)
    test = ingest_ratings(spark, test_path, test_rows)
    report = similarity_report(train, test, baseline)
    if json_path:
        write_report(report, json_path)
    return report


def knn_job(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    json_path: str | None = None,
    ks: Sequence[int] = REFERENCE_KS,
    train_rows: int | None = None,
    test_rows: int | None = None,
) -> DataFrame:
    """MAE for every k, the lowest k beating the all-users MAE, table bytes per k."""
    train = ingest_ratings(spark, train_path, train_rows)
    test = ingest_ratings(spark, test_path, test_rows)
    report = knn_report(train, test, ks)
    if json_path:
        write_report(report, json_path)
    return report


def recommend_job(
    spark: SparkSession,
    data_path: str,
    personal_path: str,
    json_path: str | None = None,
    ks: Sequence[int] = RECOMMEND_KS,
    n: int = TOP_N,
    user: int = NEW_USER,
    data_rows: int | None = None,
    personal_rows: int | None = None,
) -> DataFrame:
    """``(k, position, item, title, prediction)``: the top ``n`` unrated personal
    items for every ``k``, from one ranking of the personal user's neighbours."""
    ratings = ingest_ratings(spark, data_path, data_rows)
    if not ratings.where(F.col("user") == user).isEmpty():
        raise ValueError(f"user {user} already has ratings: choose a new id for the personal list")
    personal = ingest_personal(spark, personal_path, personal_rows)
    out = recommend_per_k(ratings, personal, ks, n, user)
    if json_path:
        entry = F.struct("position", "item", "title", "prediction")
        (
            out.groupBy("k")
            .agg(F.sort_array(F.collect_list(entry)).alias("top"))
            .agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("top"), F.lit(n), F.lit("_k"), F.col("k").cast("string")), "top"))).alias("answers"))
            .coalesce(1)
            .write.mode("overwrite")
            .json(json_path)
        )
    return out

