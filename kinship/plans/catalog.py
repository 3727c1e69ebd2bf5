"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them read the driver's parquet tables through the derived views of
``kinship.sources.tables`` and run over the whole tables. Doubles are reported
rounded to 6 decimals (``tidy``) so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.functions.columns import PRED_DIGITS, safe_ratio, tidy
from kinship.operators import features as feat
from kinship.operators import recommend as rec
from kinship.operators.evaluate import BASELINE_MAE, REFERENCE_KS, k_sweep, lowest_k, mae, mae_of_metrics, mae_value, sweep_and_baseline
from kinship.operators.predict import all_users_sums, nearest, predict, predict_both_metrics
from kinship.operators.reports import knn_report, similarity_report
from kinship.operators.similarity import all_pairs, co_ratings, needs_norms, pair_input, similarity_from_pairs
from kinship.operators.skew import SkewPolicy, plan_join
from kinship.operators.stats import knn_bytes, multiplications_total, nonzero_bytes, summary_with_zeros
from kinship.session import write_table_path
from kinship.sources.files import ratings_profile
from kinship.sources.tables import load_table, personal_from_parts, ratings_from_orders, split_holding_out_items, split_ratings

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the registered queries.
NEIGHBOUR_K = 10
WIDE_K = 1400  # nearly all users of a small table, so that negative neighbours get ranks
SALT_ROWS = 10  # buckets of co_ratings_salted: most items are cut
PREDICT_K = 30
SMALL_KS = (1, 3, 5, 10)  # fewer neighbours than most items have raters
RECOMMEND_KS = (30, 300)
TOP_N = 5


_DERIVED: dict[tuple, str] = {}


def _input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and modification time of every input file, from the file system
    that Spark itself reads (a listing, bounded by the number of files)."""
    sc = spark.sparkContext
    files = []
    for name in ("orders", "lineitem"):
        for uri in sorted(load_table(spark, sf_dir, name).inputFiles()):
            path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(uri))
            status = path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path)
            files.append((uri, status.getLen(), status.getModificationTime()))
    return (sc.applicationId, tuple(files))


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ratings view, written to the shared checkpoint folder.

    The queries read the ratings in many branches (means, deviations, both
    sides of the co-rating join, targets, scalar subqueries), so the view is
    derived from orders and lineitem once and then scanned as parquet. It is
    the workload's input table: written once per application and input files
    (keyed by path, size and modification time), then read by every query.
    """
    key = _input_key(spark, sf_dir)
    path = _DERIVED.get(key)
    if path is None:
        path = write_table_path(ratings_from_orders(spark, sf_dir), "ratings")
        _DERIVED[key] = path
    return spark.read.parquet(path)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_ratings(_ratings(spark, sf_dir))


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train split without materialisation, for single-pass queries."""
    return split_ratings(ratings_from_orders(spark, sf_dir))[0]


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[tidy(c, PRED_DIGITS).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- sources and projections -------------------------------------------------

def q_ratings(spark, sf_dir):
    return ratings_from_orders(spark, sf_dir)


def q_ratings_profile(spark, sf_dir):
    return ratings_profile(ratings_from_orders(spark, sf_dir))


def q_personal(spark, sf_dir):
    return personal_from_parts(spark, sf_dir)


def q_ratings_by_user(spark, sf_dir):
    return _train(spark, sf_dir).select("user", "item", "rating")


def q_ratings_by_item(spark, sf_dir):
    return _train(spark, sf_dir).select("item", "user", "rating")


def q_personal_train(spark, sf_dir):
    return rec.personal_train(personal_from_parts(spark, sf_dir))


def q_personal_targets(spark, sf_dir):
    return rec.personal_targets(personal_from_parts(spark, sf_dir))


def q_train_with_personal(spark, sf_dir):
    return rec.train_with_personal(ratings_from_orders(spark, sf_dir), personal_from_parts(spark, sf_dir))


# --- per-user / per-item features ----------------------------------------------

def q_user_avg(spark, sf_dir):
    return _round(feat.user_avg(_train(spark, sf_dir)), "avg_rating")


def q_item_avg(spark, sf_dir):
    return _round(feat.item_avg(_train(spark, sf_dir)), "avg_rating")


def q_global_avg(spark, sf_dir):
    return _round(feat.global_avg(_train(spark, sf_dir)), "global_avg")


def q_user_norm(spark, sf_dir):
    return _round(feat.user_norm(feat.normalized_deviation(_split(spark, sf_dir)[0])), "norm")


def q_user_count(spark, sf_dir):
    return feat.user_count(_train(spark, sf_dir)).select(F.col("n_users").cast("long").alias("n_users"))


def q_pair_count(spark, sf_dir):
    return feat.pair_count(_train(spark, sf_dir))


def q_user_items(spark, sf_dir):
    """Item set per user in relational form: one row per (user, item) plus the set size."""
    train = _split(spark, sf_dir)[0]
    sizes = feat.user_table(train, False).select("user", F.col("n_ratings").alias("n_items"))
    return train.select("user", "item").join(sizes, "user")


def q_normalized_deviation(spark, sf_dir):
    dev = feat.normalized_deviation(_split(spark, sf_dir)[0])
    return _round(dev.select("user", "item", "rating", "avg_rating", "dev"), "avg_rating", "dev")


def q_preprocessed(spark, sf_dir):
    pre = feat.preprocess(_split(spark, sf_dir)[0])
    return _round(pre.select("user", "item", "dev", "ndev"), "dev", "ndev")


# --- pairs, similarities and their statistics ----------------------------------

def _similarities(train, metric):
    return similarity_from_pairs(all_pairs(train, (metric,)), metric)


def q_co_ratings(spark, sf_dir):
    return all_pairs(_split(spark, sf_dir)[0]).select("user", "neighbour", "overlap")


def q_co_ratings_salted(spark, sf_dir):
    """``co_ratings`` with nearly every item cut into buckets."""
    train = _split(spark, sf_dir)[0]
    plan = plan_join(train, train, "item", SkewPolicy(bucket_rows=SALT_ROWS))
    return co_ratings(pair_input(train), plan).select("user", "neighbour", "overlap")


def _similarity(metric):
    def run(spark, sf_dir):
        return _round(_similarities(_split(spark, sf_dir)[0], metric), "sim")

    return run


def q_overlap_stats(spark, sf_dir):
    train = _split(spark, sf_dir)[0]
    n_pairs = feat.pair_count(train).select("n_pairs").scalar()
    return _round(summary_with_zeros(all_pairs(train), "overlap", n_pairs),
                  "min_value", "max_value", "mean_value", "stddev_value")


def _similarity_stats(metric):
    def run(spark, sf_dir):
        train = _split(spark, sf_dir)[0]
        n_pairs = feat.pair_count(train).select("n_pairs").scalar()
        return _round(summary_with_zeros(_similarities(train, metric), "sim", n_pairs),
                      "min_value", "max_value", "mean_value", "stddev_value")

    return run


def q_multiplications_total(spark, sf_dir):
    return multiplications_total(_split(spark, sf_dir)[0])


def _similarity_bytes(metric):
    def run(spark, sf_dir):
        return nonzero_bytes(_similarities(_split(spark, sf_dir)[0], metric))

    return run


def q_knn_bytes(spark, sf_dir):
    return knn_bytes(_train(spark, sf_dir), REFERENCE_KS)


def _neighbors(metric, k):
    def run(spark, sf_dir):
        train = _split(spark, sf_dir)[0]
        return _round(nearest(train, feat.user_table(train, needs_norms(metric)), metric, k), "sim")

    return run


# --- predictions and errors ----------------------------------------------------

def _predict(metric, k):
    def run(spark, sf_dir):
        train, targets = _split(spark, sf_dir)
        return _round(predict(train, targets, metric, k), "prediction")

    return run


def q_weighted_deviation(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    sums = all_users_sums(train, targets, feat.user_table(train), ("cosine",))
    return _round(sums.select("user", "item", safe_ratio("num_cosine", "den_cosine").alias("w")), "w")


def cold_targets(targets: DataFrame) -> DataFrame:
    """The targets plus, for every target, copies whose user, item or both are
    unknown to the train set (ids mapped to -(id + 2), never a real or the
    personal id), so every fallback path runs over the whole target set."""
    fresh = lambda c: (-(F.col(c) + F.lit(2))).alias(c)
    base = targets.select("user", "item", "rating")
    return (
        base.unionByName(base.select(fresh("user"), "item", "rating"))
        .unionByName(base.select("user", fresh("item"), "rating"))
        .unionByName(base.select(fresh("user"), fresh("item"), "rating"))
    )


def q_predict_cold_start(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    return _round(predict(train, cold_targets(targets), "cosine", 0), "prediction")


def q_cold_items(spark, sf_dir):
    """Targets (with the cold copies) whose item no train user rated."""
    train, targets = _split(spark, sf_dir)
    return cold_targets(targets).join(train.select("item"), "item", "left_anti").select("user", "item")


def q_predict_held_out_items(spark, sf_dir):
    train, targets = split_holding_out_items(_ratings(spark, sf_dir))
    return _round(predict(train, targets, "cosine", 0), "prediction")


def q_cold_items_held_out(spark, sf_dir):
    """Targets of the item split whose item no train user rated."""
    train, targets = split_holding_out_items(_ratings(spark, sf_dir))
    return targets.join(train.select("item"), "item", "left_anti").select("user", "item")


def _mae(metric):
    def run(spark, sf_dir):
        train, targets = _split(spark, sf_dir)
        return _round(mae(predict(train, targets, metric, 0)), "mae")

    return run


def q_mae_deltas(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    preds, _ = predict_both_metrics(train, targets)
    jac = F.col("jaccard_mae")
    out = mae_of_metrics(preds).select(
        "cosine_mae",
        "jaccard_mae",
        (F.col("cosine_mae") - F.lit(BASELINE_MAE)).alias("cosine_minus_baseline"),
        (jac - F.lit(BASELINE_MAE)).alias("jaccard_minus_baseline"),
        (jac - F.col("cosine_mae")).alias("jaccard_minus_cosine"),
    )
    return _round(out, *out.columns)


def q_knn_sweep(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    return _round(k_sweep(train, targets, REFERENCE_KS), "mae")


def q_knn_sweep_neighbour_first(spark, sf_dir):
    """A sweep in which most items have more raters than the largest ``k``."""
    train, targets = _split(spark, sf_dir)
    return _round(k_sweep(train, targets, SMALL_KS, wide_times=1), "mae")


def q_knn_lowest_k(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    sweep, everyone = sweep_and_baseline(train, targets, REFERENCE_KS)
    best = lowest_k(sweep, mae_value(everyone))
    return _round(best.select(F.col("k").cast("int").alias("k"), "mae", "mae_minus_baseline"), "mae", "mae_minus_baseline")


# --- recommendations and reports -----------------------------------------------

def _recommend(k, n=TOP_N):
    def run(spark, sf_dir):
        return rec.recommend(_ratings(spark, sf_dir), personal_from_parts(spark, sf_dir), k, n)

    return run


def q_recommend_per_k(spark, sf_dir):
    """The top lists for all ``k`` from one ranking of the personal user's neighbours."""
    return rec.recommend_per_k(_ratings(spark, sf_dir), personal_from_parts(spark, sf_dir), RECOMMEND_KS, TOP_N)


def q_report_similarity(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    return _round(similarity_report(train, targets), "value")


def q_report_knn(spark, sf_dir):
    train, targets = _split(spark, sf_dir)
    return _round(knn_report(train, targets), "value")


QUERIES: dict[str, Query] = {
    "ratings": q_ratings,
    "ratings_profile": q_ratings_profile,
    "personal": q_personal,
    "ratings_by_user": q_ratings_by_user,
    "ratings_by_item": q_ratings_by_item,
    "personal_train": q_personal_train,
    "personal_targets": q_personal_targets,
    "train_with_personal": q_train_with_personal,
    "user_avg": q_user_avg,
    "item_avg": q_item_avg,
    "global_avg": q_global_avg,
    "user_norm": q_user_norm,
    "user_count": q_user_count,
    "pair_count": q_pair_count,
    "user_items": q_user_items,
    "normalized_deviation": q_normalized_deviation,
    "preprocessed": q_preprocessed,
    "co_ratings": q_co_ratings,
    "co_ratings_salted": q_co_ratings_salted,
    "similarity_cosine": _similarity("cosine"),
    "similarity_jaccard": _similarity("jaccard"),
    "overlap_stats": q_overlap_stats,
    "multiplications_total": q_multiplications_total,
    "similarity_bytes_cosine": _similarity_bytes("cosine"),
    "similarity_bytes_jaccard": _similarity_bytes("jaccard"),
    "similarity_stats_cosine": _similarity_stats("cosine"),
    "similarity_stats_jaccard": _similarity_stats("jaccard"),
    "knn_bytes": q_knn_bytes,
    "neighbors_cosine_k10": _neighbors("cosine", NEIGHBOUR_K),
    "neighbors_cosine_k1400": _neighbors("cosine", WIDE_K),
    "neighbors_jaccard_k10": _neighbors("jaccard", NEIGHBOUR_K),
    "weighted_deviation": q_weighted_deviation,
    "predict_cosine_all": _predict("cosine", 0),
    "predict_jaccard_all": _predict("jaccard", 0),
    "predict_cosine_k30": _predict("cosine", PREDICT_K),
    "predict_jaccard_k30": _predict("jaccard", PREDICT_K),
    "predict_cold_start": q_predict_cold_start,
    "cold_items": q_cold_items,
    "predict_held_out_items": q_predict_held_out_items,
    "cold_items_held_out": q_cold_items_held_out,
    "mae_cosine": _mae("cosine"),
    "mae_jaccard": _mae("jaccard"),
    "mae_deltas": q_mae_deltas,
    "knn_sweep": q_knn_sweep,
    "knn_sweep_neighbour_first": q_knn_sweep_neighbour_first,
    "knn_lowest_k": q_knn_lowest_k,
    "personal_predictions_k30": _recommend(RECOMMEND_KS[0], None),
    "recommend_k30": _recommend(RECOMMEND_KS[0]),
    "recommend_k300": _recommend(RECOMMEND_KS[1]),
    "recommend_per_k": q_recommend_per_k,
    "report_similarity": q_report_similarity,
    "report_knn": q_report_knn,
}
