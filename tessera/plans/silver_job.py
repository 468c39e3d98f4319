"""The daily bronze -> silver job as one DataFrame composition.

read both segments -> normalise -> read earlier silver partitions -> merge
and check -> publish valid and quarantine partitions -> record the run
document.  On error a failure document is recorded and the error re-raised;
a later run of that day with success takes it back.

Actions per run: the bronze emptiness probes (LIMIT 1 each), one write per
output, one summary aggregation.  The normalised batch and the checked frame
feeding all three hold every text; each is written once as files beside the
silver table, read by the columns that a step needs, and removed after the run,
so they take no executor memory.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.normalize import normalize_reviews
from tessera.plans import run_metrics as rm
from tessera.plans.validation import quality_summary, validate
from tessera.schemas import INVALID_COLUMNS, PARTITION_COLUMN, SILVER_SCHEMA
from tessera.session import checkpoint_dir, shuffles_removed
from tessera.sinks.files import listing, modified, remove
from tessera.sinks.publish import ABANDONED_S, publish, read_table
from tessera.sources.bronze import read_segments
from tessera.sources.drift import read_segments_drifting
from tessera.sources.history import read_history
from tessera.sources.spread import spread
from tessera.sources.versions import prepare_versions

log = logging.getLogger(__name__)

ENV_PRE = "pre"
#: Folder beside the silver table's partitions with the files of the runs under way, and their codec.
WORK, WORK_CODEC = "_work", "zstd"


@dataclass
class JobConfig:
    bronze_base: str            # .../googlePlay  (holds <app>_<pf|pj>/odate=<d>/)
    silver_path: str            # valid rows, partitioned by odate
    quarantine_path: str        # invalid rows, partitioned by odate
    run_date: str               # yyyyMMdd, the partition written and the history cut-off
    audit_path: str | None = None
    failure_path: str | None = None
    env: str = "prod"
    source_app: str = "silver_reviews"
    owner: rm.Owner = field(default_factory=rm.Owner)
    merge_how: str = "full_outer"
    # Where batch and checked frame are kept for the run.  "files": columns in
    # files beside the silver table, lineage cut, no executor memory;
    # "persist": executor memory+disk, lost blocks recomputed from lineage;
    # "checkpoint": the checked frame is written once under spark.checkpoint.dir,
    # lineage cut, so a lost executor never re-runs the merge.
    materialize: str = "files"
    # Optional compacted history store (distinct versions per id, one snapshot
    # per run date): the run reads one snapshot plus the newer silver
    # partitions instead of every earlier partition.  Same results.
    versions_path: str | None = None
    # Optional table of bronze files that cannot be read, partitioned by odate.
    # With it the scan takes files whose types differ from the declared schema,
    # too, and goes on without the unreadable ones; without it they fail the run.
    unreadable_path: str | None = None


@dataclass
class JobResult:
    valid_rows: int
    invalid_rows: int
    summary: dict
    preview_valid: list = field(default_factory=list)
    preview_invalid: list = field(default_factory=list)


def check_run_date(run_date: str) -> None:
    """The partition value is compared as text, so only a real yyyyMMdd date will do."""
    if not re.fullmatch(r"\d{8}", run_date or ""):
        raise ValueError(f"run date must be yyyyMMdd, got {run_date!r}")
    datetime.strptime(run_date, "%Y%m%d")


def work_folder(spark: SparkSession, cfg: JobConfig) -> str:
    """A folder for the run's own files; those that runs broken off long ago have left are removed."""
    work = f"{cfg.silver_path.rstrip('/')}/{WORK}"
    for name in listing(spark, work):
        if modified(spark, f"{work}/{name}") < (time.time() - ABANDONED_S) * 1000:
            remove(spark, f"{work}/{name}")
    return f"{work}/{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", WORK_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build(spark: SparkSession, cfg: JobConfig, work: str | None = None):
    """Plans of the run: (batch, Validated).

    The normalised batch is written to the folder ``work``, without one marked for
    persisting, so the merge, the rows without an id and the rows of duplicated ids
    share one bronze scan; the caller releases it.
    """
    if cfg.unreadable_path:
        raw, unreadable = read_segments_drifting(spark, cfg.bronze_base, cfg.run_date)
        publish(unreadable, cfg.unreadable_path, cfg.run_date, "unreadable")
    else:
        raw = read_segments(spark, cfg.bronze_base, cfg.run_date)
    batch = normalize_reviews(spread(raw))
    batch = kept(batch, f"{work}/batch") if work else batch.persist(StorageLevel.MEMORY_AND_DISK)
    if cfg.versions_path:
        history = prepare_versions(spark, cfg.versions_path, cfg.silver_path, cfg.run_date)
    else:
        history = read_history(spark, cfg.silver_path, cfg.run_date)
    # A full scan of history is worth passes over its ids and digests; the store's buckets need no exchange that they would save.
    scan = not cfg.versions_path
    return batch, validate(batch, history, cfg.run_date, how=cfg.merge_how, filter_history=cfg.merge_how == "left_outer" and scan, thin_history=scan)


def run(spark: SparkSession, cfg: JobConfig) -> JobResult:
    """Run one day.

    Both outputs are published: written aside, then committed by one record
    each, so a run that fails leaves the tables as they were.  The summary
    comes first; it knows the run's segments, should a later step fail.  The
    silver table, which the next run reads as history, is committed last.
    """
    start = rm.RunClock.now()
    batch = v = client = work = None
    try:
        check_run_date(cfg.run_date)
        work = work_folder(spark, cfg) if cfg.materialize == "files" else None
        batch, v = build(spark, cfg, work)
        if work:
            checked = kept(v.checked, f"{work}/checked")
        elif cfg.materialize == "checkpoint":
            checkpoint_dir(spark)  # the session's folder; a local one only when unset
            checked = v.checked.checkpoint(eager=True)
        else:
            checked = v.checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary_row = quality_summary(checked).first().asDict()
            client = summary_row.pop("segments")
            v = rebuild_outputs(batch, checked, v)
            n_invalid = publish(v.invalid, cfg.quarantine_path, cfg.run_date, "invalid")
            preview_v, preview_i = [], []
            if cfg.env == ENV_PRE:
                preview_v = v.valid.take(10)
                preview_i = v.invalid.take(10)
            if work:
                remove(spark, f"{work}/batch")  # what is left to do needs the checked frame alone
            n_valid = publish(v.valid, cfg.silver_path, cfg.run_date, "valid", schema=SILVER_SCHEMA)
        finally:
            if cfg.materialize == "persist":
                checked.unpersist()
        if cfg.audit_path:
            clock = rm.RunClock(start, rm.RunClock.now())
            summary_df = spark.createDataFrame([Row(**summary_row)])
            doc = rm.metrics_document(
                summary_df, application_id=spark.sparkContext.applicationId,
                source_app=cfg.source_app, owner=cfg.owner, clock=clock)
            rm.upsert_document(doc, cfg.audit_path, cfg.source_app, cfg.run_date)
        if cfg.failure_path:
            rm.withdraw_document(spark, cfg.failure_path, cfg.source_app, cfg.run_date)
        return JobResult(n_valid, n_invalid, summary_row, preview_v, preview_i)
    except Exception as err:
        log.error("silver job failed: %s", err)
        if cfg.failure_path:
            try:
                rm.upsert_document(rm.failure_document(spark, err, client, cfg.owner), cfg.failure_path, cfg.source_app, cfg.run_date)
            except Exception as inner:  # the original error is what matters
                log.error("could not write the failure document: %s", inner)
        raise
    finally:
        for frame in ([batch] if batch is not None else []) + (v.held if v is not None else []):
            frame.unpersist()
        if work:
            remove(spark, work)


def rebuild_outputs(batch, checked: DataFrame, v):
    """Valid / invalid outputs re-derived from a materialised checked frame, whose duplicated ids are known and filter the batch."""
    from tessera.operators import quality as q
    from tessera.plans.validation import Validated, duplicate_batch_rows
    dups = duplicate_batch_rows(batch, checked, v.raw_batch, filtered=True).select(*INVALID_COLUMNS)
    return Validated(checked=checked, valid=q.split_valid(checked), invalid=q.split_invalid(checked, dups),
                     duplicates=dups, raw_batch=v.raw_batch, held=v.held)


QUARANTINE_SCHEMA = StructType([StructField(c, StringType(), True) for c in INVALID_COLUMNS])


def read_back(spark: SparkSession, path: str, schema: StructType = SILVER_SCHEMA) -> DataFrame:
    """Read an output table with its declared schema, as its newest commit has
    it; ``odate`` stays a string (no partition type inference)."""
    df = read_table(spark, path, schema)
    return df if df is not None else spark.createDataFrame([], StructType([*schema.fields, StructField(PARTITION_COLUMN, StringType(), True)]))


def main(argv: list[str] | None = None) -> int:
    """``spark-submit -m tessera.plans.silver_job <env> --bronze ... --silver ... ...``

    The session comes from ``getOrCreate`` (the submitter configures it).
    Returns 0 on success; on any error logs it, writes the failure document
    (when a path is given) and returns 1.  The session is stopped either way.
    """
    import argparse

    ap = argparse.ArgumentParser(prog="silver_job")
    ap.add_argument("env", choices=["pre", "prod"])
    ap.add_argument("--bronze", required=True, help="base folder holding <app>_<pf|pj>/odate=<d>/")
    ap.add_argument("--silver", required=True)
    ap.add_argument("--quarantine", required=True)
    ap.add_argument("--run-date", default=datetime.now(timezone.utc).strftime("%Y%m%d"))
    ap.add_argument("--audit", default=None)
    ap.add_argument("--failures", default=None)
    ap.add_argument("--materialize", choices=["files", "persist", "checkpoint"], default="files")
    ap.add_argument("--unreadable", default=None, help="table of unreadable bronze files; makes the scan tolerant")
    ap.add_argument("--versions", default=None, help="folder of the compacted history store")
    ap.add_argument("--merge-how", choices=["full_outer", "left_outer"], default="full_outer")
    args = ap.parse_args(argv)
    spark = None
    try:
        spark = SparkSession.builder.appName("tessera silver job").getOrCreate()
        run(spark, JobConfig(bronze_base=args.bronze, silver_path=args.silver,
                             quarantine_path=args.quarantine, run_date=args.run_date,
                             audit_path=args.audit, failure_path=args.failures, env=args.env,
                             materialize=args.materialize, versions_path=args.versions, unreadable_path=args.unreadable, merge_how=args.merge_how))
        return 0
    except Exception as err:  # reported in the failure document and the log
        log.error("job failed: %s", err)
        return 1
    finally:
        if spark is not None:
            spark.stop()


if __name__ == "__main__":
    import sys
    sys.exit(main())
