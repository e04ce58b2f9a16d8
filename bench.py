"""Times the registered queries and prints one JSON line.

Each query is written to Spark's no-op sink, so every row and column is computed. A short
warm-up on the smallest scale takes class loading out of the first measurement.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plimsoll.plans.registry import QUERIES  # noqa: E402
from plimsoll.session import local_session  # noqa: E402

HEADLINE = ["scorecard", "auc", "group_fpr", "tfidf_weights", "train_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, int(cores), spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"))
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("scorecard", "group_fpr"):
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of all registered queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "headline": {k: times[k] for k in HEADLINE if k in times}, "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
