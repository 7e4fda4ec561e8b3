"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores.  Each query runs once to warm up and then BENCH_RUNS
times (default 2); the fastest run counts.
"""

import json
import os
import time

from cellshift.catalog import QUERIES
from cellshift.session import local_session

HEADLINE = (
    "experiment_summary",
    "experiment_comparison",
    "delta_entries",
    "perturbed_matrix",
    "cohort_members",
    "baseline_embeddings",
    "user_model_embeddings",
    "cosine_distances",
    "distance_summaries",
    "embeddings_round_trip",
    "dataset_profile",
    "describe_cell_total",
    "cell_totals",
    "gene_totals",
    "size_factors",
    "registry_contents",
    "layered_contents",
    "memo_to_do",
    "run_versions",
    "manifest_records",
    "run_documents",
    "comparison_manifest_check",
    "latest_materializations",
    "failed_check_alerts",
    "alert_stream",
    "text_slugs",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, max(1, int(cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
