"""Print the executed (adaptive, final) physical plan of registered queries and
a summary of the operators that matter at scale.

    python tools/explain.py /root/testdata/sf0.01 predict_cosine_k30 [key ...] [--full]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WATCH = ("Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange", "ReusedExchange",
         "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "WindowGroupLimit", "Generate", "TakeOrderedAndProject",
         "BatchEvalPython", "ArrowEvalPython")


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text).split("== Initial Plan ==")[0]


def main() -> None:
    from kinship.plans.catalog import QUERIES
    from kinship.session import local_session

    args = [a for a in sys.argv[1:] if a != "--full"]
    sf_dir, keys = args[0], args[1:]
    spark = local_session(8)
    for key in keys:
        plan = final_plan(QUERIES[key](spark, sf_dir))
        print(f"== {key}")
        if "--full" in sys.argv:
            print(plan)
        for op in WATCH:
            n = plan.count(op)
            if n:
                print(f"   {op:28s} {n}")


if __name__ == "__main__":
    main()
