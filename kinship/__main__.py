"""Command line: ``spark-submit ... -m kinship {similarity,knn,recommend} ...`` (or ``python -m kinship``).

Master, memory and the shared folder are the submitter's; without any, Spark's
own default (``local[*]``) applies.
"""

from __future__ import annotations

import argparse

from kinship.plans.jobs import knn_job, recommend_job, similarity_job
from kinship.session import cleanup, session


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="kinship")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("similarity", "knn"):
        p = sub.add_parser(name)
        p.add_argument("--train", required=True)
        p.add_argument("--test", required=True)
        p.add_argument("--json")
        p.add_argument("--train-rows", type=int)
        p.add_argument("--test-rows", type=int)
    p = sub.add_parser("recommend")
    p.add_argument("--data", required=True)
    p.add_argument("--personal", required=True)
    p.add_argument("--json")
    p.add_argument("--data-rows", type=int)
    p.add_argument("--personal-rows", type=int)
    args = parser.parse_args(argv)

    spark = session()
    if args.job == "similarity":
        out = similarity_job(spark, args.train, args.test, args.json, args.train_rows, args.test_rows)
    elif args.job == "knn":
        out = knn_job(spark, args.train, args.test, args.json, train_rows=args.train_rows, test_rows=args.test_rows)
    else:
        out = recommend_job(spark, args.data, args.personal, args.json,
                            data_rows=args.data_rows, personal_rows=args.personal_rows)
    out.show(100, truncate=False)
    cleanup(spark)
    spark.stop()


if __name__ == "__main__":
    main()
