"""Plan shape of every registered query, as it would be planned on large inputs.

usage: python tools/plan_report.py [sf_dir]
Broadcast by size is switched off (``autoBroadcastJoinThreshold=-1``) so the
report shows the sort-merge plans a large cluster gets; explicit broadcasts of
parameter-bounded tables (top-k winners, vocabulary) stay.  Prints exchanges,
joins, scans, windows and any forbidden operator per query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Expand")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from shelfcast.plans.catalog import QUERIES
    from shelfcast.session import build_session
    spark = build_session(shuffle_partitions=16, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    print(f"{'query':28s} exch  smj  bhj scans win  flags")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        exch = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        flags = " ".join(f for f in FORBIDDEN if f in plan)
        print(f"{name:28s} {exch:4d} {plan.count('SortMergeJoin'):4d} {plan.count('BroadcastHashJoin'):4d} "
              f"{plan.count('FileScan'):5d} {plan.count('Window ['):3d}  {flags}")
    spark.stop()


if __name__ == "__main__":
    main()
