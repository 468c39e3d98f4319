"""Write PLANS.md: physical plans of the job's main steps on the real layout.

    python explain_plans.py [sf_dir]

Expression ids and long expressions are trimmed so the plan shape (exchanges,
aggregates, joins, scans with their pushed / partition filters and read
schemas) is readable.
"""

from __future__ import annotations

import dataclasses
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators import snapshot  # noqa: E402
from tessera.plans import silver_job  # noqa: E402
from tessera.plans.validation import quality_summary  # noqa: E402
from tessera.session import local_session, scratch_path  # noqa: E402
from tessera.sources import fixtures as fx  # noqa: E402


def shape(plan: str) -> str:
    out = []
    skip_deeper = None
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip_deeper is not None:
            if depth > skip_deeper:
                continue
            skip_deeper = None
        if "InMemoryRelation" in line:
            out.append(line[:line.index("InMemoryRelation")] + "InMemoryRelation (the persisted merged frame above)")
            skip_deeper = depth
            continue
        if "FileScan" in line or "Scan parquet" in line:
            m = re.search(r"^(.*?(?:FileScan|Scan) parquet)", line)
            parts = [m.group(1) if m else line[:60]]
            for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                k = re.search(rf"{key}: (\[[^\]]*\]|struct<[^ ]*)", line)
                if k:
                    parts.append(f"{key}: {k.group(1)[:160]}")
            out.append(" ".join(parts))
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        out.append(line[:170] + (" ..." if len(line) > 170 else ""))
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    base = scratch_path(spark, "plans")
    cfg = silver_job.JobConfig(bronze_base=f"{base}/bronze/googlePlay", silver_path=f"{base}/silver",
                               quarantine_path=f"{base}/quarantine", run_date=fx.RUN_DATE)
    fx.write_bronze_layout(spark, sf, cfg.bronze_base)
    fx.write_history_table(spark, sf, cfg.silver_path, late_copy_date=None)
    batch, v = silver_job.build(spark, cfg)
    sections = [
        ("Merged and checked frame (persisted once per run)", v.checked),
        ("Quarantine output (reads the persisted frame; duplicates by semi join on the raw batch)", v.invalid),
        ("One-row summary", quality_summary(v.checked)),
        ("Silver output", v.valid),
    ]
    others = [  # planned on their own, before anything is persisted
        ("Merge with the incremental history store: its buckets need no exchange", dataclasses.replace(cfg, versions_path=f"{base}/versions")),
        ("Left outer merge: the history scan is filtered by the batch's ids", dataclasses.replace(cfg, merge_how="left_outer")),
    ]
    extra = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    for title, other in others:
        b, w = silver_job.build(spark, other)
        b.unpersist()
        extra.append((title, w.checked._jdf.queryExecution().executedPlan().toString()))
    salted = snapshot.salted_history_join(fx.norm(spark, sf), fx.hist(spark, sf), run_date=fx.RUN_DATE)
    extra.append(("Salted join: salts for what the sketch finds", salted._jdf.queryExecution().executedPlan().toString()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = ["# Physical plans of the daily job", "",
             f"Generated by `python explain_plans.py {sf}` (local[8], AQE on, before execution).",
             "Expression ids are removed and long expressions cut.", ""]
    checked = None
    for title, df in sections:
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {title}", "", "```", shape(plan).rstrip(), "```", ""]
        if checked is None:  # the job persists the merged frame; later steps read it
            checked = v.checked.persist()
    checked.unpersist()
    for title, plan in extra:
        lines += [f"## {title}", "", "```", shape(plan).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
