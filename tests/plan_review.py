"""Summarise the physical plan of every registered query (markdown table).

Usage: python tests/plan_review.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    import __spark_entry__ as E
    from stratiform.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | hash shuffles | range shuffles | broadcasts | sort-merge joins | python | single-partition |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in E.queries().items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [
            plan.count("Exchange hashpartitioning"),
            plan.count("Exchange rangepartitioning") + plan.count("RepartitionByExpression"),
            plan.count("BroadcastExchange"),
            plan.count("SortMergeJoin"),
            sum(plan.count(k) for k in ("BatchEvalPython", "ArrowEvalPython", "PythonMapInArrow", "MapInPandas")),
            plan.count("SinglePartition"),
        ]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main()
