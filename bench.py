"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion ``BENCH_REPEATS`` times (default 2; results go
to Spark's ``noop`` sink, so nothing is collected) after one warm-up query that
starts the JVM; the fastest full run of each query is reported (this VM's
timing noise is about +-15 %), with the first run and the derivation of the ratings view,
which is written once before the queries, beside it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinship.plans.catalog import QUERIES, _ratings  # noqa: E402
from kinship.session import cleanup, local_session  # noqa: E402

HEADLINE = (
    "mae_cosine",           # similarity-based predictor, adjusted cosine, all users
    "mae_jaccard",          # same with Jaccard
    "predict_cosine_k30",   # k-nearest predictions
    "knn_sweep",            # MAE for nine k in one pass
    "similarity_cosine",    # the pair table itself
    "recommend_k30",        # top 5 for the personal user
    "recommend_k300",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * int(cpus)))))
    spark = local_session(cpus, shuffle_partitions=parts, app="kinship-bench")
    QUERIES["user_count"](spark, sf_dir).collect()  # warm-up
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    t0 = time.perf_counter()
    _ratings(spark, sf_dir)  # orders join lineitem, written once and read by every query below
    derivation = round(time.perf_counter() - t0, 3)
    times, first = {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name], first[name] = round(min(runs), 3), round(runs[0], 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "derivation": derivation,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "repeats": repeats,
        "stat": "min",
    }))
    cleanup(spark)
    spark.stop()


if __name__ == "__main__":
    main()
