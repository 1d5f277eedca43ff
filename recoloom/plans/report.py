"""Physical-plan summary of registered queries (run after execution, so AQE's
final plan is reported): exchanges, join strategies, window limits, Python
stages, and whether the scans received pushed filters.

    python -m recoloom.plans.report [/sf/dir] [names...]
"""

from __future__ import annotations

import re
import sys

MARKERS = {
    "shuffles": r"(?<!Broadcast)(?<!Reused)Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "single_partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window_group_limit": r"WindowGroupLimit",
    "python_stages": r"FlatMapCoGroupsInPandas|MapInPandas|MapInArrow|ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython",
    "pushed_filter_scans": r"PushedFilters: \[[^\]]",
}


def summarize(plan: str) -> dict:
    return {k: len(re.findall(v, plan)) for k, v in MARKERS.items()}


def main(argv):
    from ..session import local_session
    from . import QUERIES
    sf_dir = next((a for a in argv if a.startswith("/")), "/root/testdata/sf0.1")
    names = [a for a in argv if not a.startswith("/")] or sorted(QUERIES)
    spark = local_session(8, 16)
    print("| query | " + " | ".join(MARKERS) + " |")
    print("| --- |" + " --- |" * len(MARKERS))
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {n} | " + " | ".join(str(s[k]) for k in MARKERS) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
