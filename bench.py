"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).  Before timing, every headline query runs
once on the smallest supplied tables so JIT compilation and Python worker
start-up are not billed to the first timed query (steady-state numbers).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_aggregates", "order_user_aggregates", "post_aggregates", "asof_features", "asof_multi_view",
    "split_chronological", "ranking_negatives", "retrieval_pairs", "knn_exact", "knn_category",
    "topk_accuracy", "recommend", "binary_metrics", "window_counts", "keywords", "latest_features",
    "feature_matrix", "knn_ivf", "upsert_interactions", "text_vectors", "rolling_counts", "knn_index_exact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from recoloom.plans import QUERIES
    from recoloom.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir.rstrip("/"):
        for n in names:                                         # untimed warm-up pass
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
