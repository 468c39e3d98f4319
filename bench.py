"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully computed through the ``noop`` sink (no driver collect);
the end-to-end job is timed from reading bronze to the appended run document,
after its input folders have been written.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera import registry  # noqa: E402
from tessera.plans import silver_job  # noqa: E402
from tessera.session import local_session, scratch_path  # noqa: E402
from tessera.sources import fixtures as fx  # noqa: E402

HEADLINE = [
    "normalize_reviews",
    "accent_fold",
    "snapshot_merge",
    "change_detection",
    "history_collect",
    "duplicate_rows",
    "split_valid",
    "split_invalid",
    "quality_summary",
    "salted_history_join",
    "kv_report_parse",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    n = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cpus, max(8, 2 * n), app_name="tessera-bench", extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    queries = registry.all_queries()

    run_noop(queries["snapshot_merge"](spark, sf_dir))  # warm-up (JIT, codegen caches)

    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeats):
            t0 = time.perf_counter()
            run_noop(queries[name](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        timings[name] = round(best, 3)

    # End-to-end job: bronze layout + history table written first (setup).
    base = scratch_path(spark, "bench-job")
    cfg = silver_job.JobConfig(
        bronze_base=f"{base}/bronze/googlePlay", silver_path=f"{base}/silver",
        quarantine_path=f"{base}/quarantine", run_date=fx.RUN_DATE, audit_path=f"{base}/audit")
    fx.write_bronze_layout(spark, sf_dir, cfg.bronze_base)
    fx.write_history_table(spark, sf_dir, cfg.silver_path, late_copy_date=None)
    best = float("inf")
    for _ in range(repeats):
        t0 = time.perf_counter()
        silver_job.run(spark, cfg)
        best = min(best, time.perf_counter() - t0)
    timings["silver_job"] = round(best, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
