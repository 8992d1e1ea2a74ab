"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from frameline.fixtures import Tables
from frameline.registry import load
from frameline.session import build_session

HEADLINE = (
    "orphan_bytes_by_job", "orphan_objects", "expired_objects", "cleanup_summary", "lifecycle_action", "delete_calls", "upsert_jobs",
    "make_jobs", "plan_frame_batches", "missing_frames", "remaining_frames", "job_progress", "retry_outcome", "frame_gaps", "stage_history",
    "metric_stats", "evaluate_alarms", "cost_by", "budget_tracking", "idle_instances", "compliance_by_rule", "tile_pixels", "merge_tiles",
    "pad_reflect", "infer", "filter2d", "degrade", "shuffle_pairs", "stream_stats", "job_state_machine",
)


def measure(spark, folder: str, name: str, runs: int) -> float:
    """Median seconds to compute every row of a query (written to a sink that drops them)."""
    took = []
    for _ in range(runs):
        start = time.perf_counter()
        load()[name].run(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    return statistics.median(took)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    measure(spark, folder, "jobs_by_status", 1)  # JVM and scan warm-up
    measure(spark, folder, "pad_reflect", 1)  # Python workers
    times = {name: round(measure(spark, folder, name, runs), 3) for name in names}
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
