"""Answer reports as long ``(metric, value)`` rows.

Each part is a small aggregate of the data; the parts are unioned into one
DataFrame of a few rows. ``kinship.sources.sinks.write_report`` nests the dotted
metric names into a JSON object.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import DEFAULT_SCALE, RatingScale
from kinship.operators.evaluate import BASELINE_MAE, REFERENCE_KS, lowest_k, mae_of_metrics, mae_value, sweep_and_baseline
from kinship.operators.features import pair_count
from kinship.operators.predict import both_similarities, predict_both_metrics
from kinship.operators.similarity import METRICS
from kinship.operators.skew import DEFAULT_SKEW, SkewPolicy
from kinship.operators.stats import knn_bytes, nonzero_bytes_of, summary_with_zeros
from kinship.session import write_table


def _rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Unpivot one-row ``df`` into ``(metric, value)`` rows."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value")) for name, c in pairs])
        ).alias("r")
    ).select("r.metric", "r.value")


def similarity_report(
    train: DataFrame,
    targets: DataFrame,
    baseline: float = BASELINE_MAE,
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """MAE of both metrics (k = 0) and their differences, the number of user
    pairs, overlap statistics over all pairs and the bytes of the non-zero
    similarities of each metric.

    Everything derives from one co-rating table (dot product, overlap and both
    item counts per pair): its pairs are shuffled once, for one pass that predicts by
    both metrics and one that takes all statistics.
    """
    preds, co = predict_both_metrics(train, targets, bounds, skew)
    maes = mae_of_metrics(preds).select(
        "cosine_mae",
        "jaccard_mae",
        (F.col("cosine_mae") - F.lit(baseline)).alias("cosine_minus_baseline"),
        (F.col("jaccard_mae") - F.col("cosine_mae")).alias("jaccard_minus_cosine"),
    )
    pairs = pair_count(train)
    overlap = summary_with_zeros(both_similarities(co), "overlap", pairs.select("n_pairs").scalar(),
                                 [(f"bytes_{m}", nonzero_bytes_of(m)) for m in METRICS])
    parts = [
        _rows(maes, [
            ("cosine.mae", "cosine_mae"),
            ("cosine.minus_baseline", "cosine_minus_baseline"),
            ("jaccard.mae", "jaccard_mae"),
            ("jaccard.minus_cosine", "jaccard_minus_cosine"),
        ]),
        _rows(pairs, [("pairs.users", "n_users"), ("pairs.similarity_computations", "n_pairs")]),
        _rows(overlap, [
            ("overlap.min", "min_value"),
            ("overlap.max", "max_value"),
            ("overlap.mean", "mean_value"),
            ("overlap.stddev", "stddev_value"),
            ("bytes.nonzero_cosine", "bytes_cosine"),
            ("bytes.nonzero_jaccard", "bytes_jaccard"),
        ]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def knn_report(
    train: DataFrame,
    targets: DataFrame,
    ks: Sequence[int] = REFERENCE_KS,
    metric: str = "cosine",
    bounds: RatingScale = DEFAULT_SCALE,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """MAE for every ``k``, the lowest ``k`` that beats the all-users MAE of the
    same metric, and the bytes of each ``k``-nearest table."""
    sweep, everyone = sweep_and_baseline(train, targets, ks, metric, bounds, skew)
    sweep = write_table(sweep, "sweep")  # a row per k, read twice below
    best = lowest_k(sweep, mae_value(everyone))
    parts = [
        sweep.select(F.concat(F.lit("sweep.mae_k"), F.col("k").cast("string")).alias("metric"), F.col("mae").alias("value")),
        _rows(best, [("lowest.k", "k"), ("lowest.mae", "mae"), ("lowest.mae_minus_baseline", "mae_minus_baseline")]),
        knn_bytes(train, ks).select(
            F.concat(F.lit("bytes.k"), F.col("k").cast("string")).alias("metric"), F.col("bytes").cast("double").alias("value")
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
