"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query cold (first run, includes planning and codegen) and then warm
(median of BENCH_REPEAT further runs), forcing full evaluation with a no-op write so
every column is computed; model training is timed once beside them. Prints ONE JSON line; "queries" holds the warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskweave import registry  # noqa: E402
from riskweave.session import local_session  # noqa: E402

# headline queries: flagship scores, the heavy aggregation and windows, the history,
# the data-test suite and model scoring
HEADLINE = [
    "risk_scores",
    "weekly_usage",
    "activity_weekly",
    "rolling_wau",
    "billing_signals",
    "support_signals",
    "scd2_history",
    "alerts",
    "dq_suite",
    "rule_vs_ml",
]
# trains (cross-validation of both pipelines, refit) and scores; timed once, as a line of its own
TRAINING = "ml_train_score"


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    qs = registry.queries()
    warm, cold = {}, {}
    for name in names:
        fn = qs[name]
        cold[name] = round(run_once(spark, fn, sf_dir), 3)
        times = [run_once(spark, fn, sf_dir) for _ in range(repeat)]
        warm[name] = round(statistics.median(times), 3)
    training = {} if only else {TRAINING: round(run_once(spark, qs[TRAINING], sf_dir), 3)}
    sf = Path(sf_dir).name.replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_warm_median",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "training_once": training,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
