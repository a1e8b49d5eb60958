"""Times the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line.

`clean_claims` and `feature_job` are timed once, from the given tables to the stored claims and from those to the
stored feature table. Reports, panels and benchmark workloads read the stored feature table, uncached, whole
result computed, best of $BENCH_RUNS (3)."""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import inputs as src  # noqa: E402
from catalog.check import local_session  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from claimwright.plans.reports import REPORTS  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

ON_FEATURES = [
    "bench_full_scan_count", "bench_filter_project", "bench_group_by", "bench_join_provider_stats", "bench_scaling",
    *REPORTS, "fraud_rate_by_region", "top_suspicious_claims", "threshold_status", "provider_stats", "region_stats",
    "engineered_features", "fraud_rule_flags", "hash_split", "oversample_replicated", "binary_auc",
    "multiclass_metrics", "linear_shap", "balanced_sample", "stratified_split", "claims_with_provider_stats_shuffled",
    "dedup_claims",
]
# The first that needs the stored model pays for training it.
ONCE = ["stream_ingest_claims", "lr_train", "gbt_train", "tree_shap_additivity"]


def seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, CPUS)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    timings = {
        "clean_claims": seconds(lambda: src.claims_path(spark, SF_DIR)),
        "feature_job": seconds(lambda: src.features(spark, SF_DIR)),
    }
    for name in ON_FEATURES:
        timings[name] = min(seconds(lambda: run(name)) for _ in range(RUNS))
    src.captured_path(spark, SF_DIR)  # the stream's input
    for name in ONCE:
        timings[name] = seconds(lambda: run(name))
    rows = src.features(spark, SF_DIR).count()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS, "feature_rows": rows,
    }))


if __name__ == "__main__":
    main()
