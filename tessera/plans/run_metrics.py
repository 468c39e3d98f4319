"""Run documents: success metrics and failure record.

Documents are one-row DataFrames built from one-row aggregates (never from
collected data rows).  The job keeps one current document for each run in an
audit table (``upsert_document``); a document on its own is appended to a
folder of JSON lines (``append_document``).
"""

from __future__ import annotations

import json
import logging
import re
import zlib
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.functions.report import parse_kv_lines
from tessera.operators import quality as q
from tessera.schemas import CRITICAL_COLUMNS
from tessera.sinks.publish import commit, current, publish, read_table

log = logging.getLogger(__name__)

#: Fixed value: the client of a run whose segments are not known.
UNKNOWN_CLIENT = "UNKNOWN_CLIENT"


@dataclass
class Owner:
    """Who the run belongs to (configuration, not data)."""
    team: str = "data"
    project: str = "reviews"
    layer: str = "silver"
    job: str = "app_reviews_silver"
    priority: str = "0"
    tower: str = "data-platform"
    extra: dict = field(default_factory=dict)


@dataclass
class RunClock:
    start: datetime
    end: datetime

    @staticmethod
    def now() -> datetime:
        return datetime.now(timezone.utc)

    def minutes_text(self) -> str:
        return f"{(self.end - self.start).total_seconds() / 60:.2f} min"


def utc_iso_millis(ts: datetime) -> str:
    return ts.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def validation_struct():
    """validation_results as a struct of three {message, status, code} structs,
    from the columns of ``quality_summary``."""
    null_msg = q.null_message({c: F.col(f"null_{c}") for c in CRITICAL_COLUMNS})
    dup_msg = q.duplicate_message(F.col("duplicate_keys"))

    def one(ok, bad_code, bad_msg, ok_msg):
        return F.struct(
            F.when(ok, F.lit(ok_msg)).otherwise(bad_msg).alias("message"),
            ok.alias("status"),
            F.when(ok, F.lit(q.CODE_OK)).otherwise(F.lit(bad_code)).alias("code"))

    return F.struct(
        one(F.col("duplicate_status"), q.CODE_CONFLICT, dup_msg, q.MSG_DUP_NONE).alias(q.CHECK_DUPLICATE),
        one(F.col("null_status"), q.CODE_BAD_DATA, null_msg, q.MSG_NULL_NONE).alias(q.CHECK_NULL),
        one(F.col("type_status"), q.CODE_BAD_DATA, F.lit(q.MSG_TYPE_FOUND), q.MSG_TYPE_NONE).alias(q.CHECK_TYPE),
    )


def metrics_document(summary: DataFrame, *, application_id: str, source_app: str,
                     source_search: str = "google_play", owner: Owner | None = None,
                     clock: RunClock | None = None) -> DataFrame:
    """The success document of a run, one row with nested fields.

    ``clock`` brackets the run; without a finished one there is no processing
    time to report, so it is an error.
    """
    owner = owner or Owner()
    if clock is None or clock.start is None or clock.end is None:
        raise ValueError("a run document needs the run's start and end")
    # --- fixed values: the field names of the run document
    return summary.select(
        F.lit(application_id).alias("application_id"),
        F.struct(F.lit(owner.team).alias("team"), F.lit(owner.project).alias("project"),
                 F.lit(owner.layer).alias("layer")).alias("owner"),
        F.struct(F.col("valid_count").alias("count"), F.col("pct_valid").alias("percentage")).alias("valid_data"),
        F.struct(F.col("invalid_count").alias("count"), F.col("pct_invalid").alias("percentage")).alias("invalid_data"),
        F.col("written_total").alias("total_records"),
        F.col("total_records").alias("checked_records"),
        F.lit(clock.minutes_text()).alias("total_processing_time"),
        (F.col("valid_text_bytes") / (1024 * 1024)).alias("memory_used"),
        validation_struct().alias("validation_results"),
        "success_count", "error_count", "type_client",
        F.struct(F.lit(source_app).alias("app"), F.lit(source_search).alias("search")).alias("source"),
        F.struct(F.lit(clock.start.strftime("%Y-%m-%d %H:%M:%S")).alias("start_ts"),
                 F.lit(clock.end.strftime("%Y-%m-%d %H:%M:%S")).alias("end_ts")).alias("_ts"),
        F.lit(utc_iso_millis(RunClock.now())).alias("timestamp"),
    )


def client_segments(df: DataFrame) -> list[str | None]:
    """Distinct segments of ``df`` in order, a null one last: a handful of folder names."""
    rows = df.select("segmento").distinct().collect()
    return sorted((r[0] for r in rows if r[0] is not None)) + [None] * any(r[0] is None for r in rows)


def failure_document(spark: SparkSession, error: BaseException | str, client: DataFrame | list | None = None,
                     owner: Owner | None = None) -> DataFrame:
    """One-row failure record.

    ``client`` are the run's segments, or a frame that has them.  If there is
    none, or its segments cannot be read (the batch itself may be what
    failed), the client is ``UNKNOWN_CLIENT``; the document never depends on
    the data being readable.
    """
    if not error:
        raise ValueError("a failure document needs an error")
    owner = owner or Owner()
    if isinstance(client, DataFrame):
        try:
            client = client_segments(client) if "segmento" in client.columns else None
        except Exception as err:  # whatever is wrong with the batch, the record is written
            log.warning("segments of the failed run are not readable: %s", err)
            client = None
    names = [F.lit(c).cast("string") for c in (client or [UNKNOWN_CLIENT])]
    return spark.range(1, numPartitions=1).select(
        F.lit(utc_iso_millis(RunClock.now())).alias("timestamp"),
        F.lit(owner.layer).alias("layer"),
        F.lit(owner.project).alias("project"),
        F.lit(owner.job).alias("job"),
        F.lit(owner.priority).alias("priority"),
        F.lit(owner.tower).alias("tower"),
        F.array(*names).alias("client"),
        F.lit(str(error) or "unknown error").alias("error"),
    )


def append_document(doc: DataFrame | str | dict, path: str, spark: SparkSession | None = None) -> None:
    """Append a run document to a JSON-lines audit table.

    Accepts a one-row DataFrame, a dict, or a JSON object as a string, which is
    written as one line however it is laid out.
    """
    if not path:
        raise ValueError("audit path must not be empty")
    if isinstance(doc, DataFrame):
        doc.write.mode("append").json(path)  # one row: one partition, one file
        return
    if isinstance(doc, str):
        try:
            parsed = json.loads(doc)
        except json.JSONDecodeError as err:
            raise ValueError("metrics document is not valid JSON") from err
        if not isinstance(parsed, dict):
            raise ValueError("a metrics document is a JSON object")
        text = json.dumps(parsed)
    elif isinstance(doc, dict):
        text = json.dumps(doc)
    else:
        raise TypeError(f"unsupported document type {type(doc).__name__}")
    if spark is None:
        raise ValueError("a session is needed to write a JSON text document")
    spark.createDataFrame([(text,)], "value string").write.mode("append").text(path)


#: Table of current run documents, one row (a published partition) for each job and run date.
DOCUMENTS_SCHEMA = StructType([StructField("job", StringType()), StructField("run_date", StringType()), StructField("attempt", LongType()),
                               StructField("document", StringType())])
RUN_COLUMN = "run"


def _run_key(job: str, run_date: str) -> str:
    text = f"{job}-{run_date}"
    plain = re.sub(r"[^A-Za-z0-9._-]", "_", text)
    return plain if plain == text else f"{plain}-{zlib.crc32(text.encode()):08x}"


def upsert_document(doc: DataFrame, path: str, job: str, run_date: str) -> int:
    """Make ``doc`` (one row) the document of the run (job, run date), in place of an earlier one; the attempt, from 1.

    The table has one row for each run, however often it was repeated; the
    row is replaced by one commit, so a reader finds the earlier document or this one.
    """
    if not path:
        raise ValueError("audit path must not be empty")
    spark, key = doc.sparkSession, _run_key(job, run_date)
    held = current_documents(spark, path).where((F.col("job") == job) & (F.col("run_date") == run_date)).agg(F.max("attempt")).first()[0]
    attempt = (held or 0) + 1
    row = doc.select(F.lit(job).alias("job"), F.lit(run_date).alias("run_date"), F.lit(attempt).cast("long").alias("attempt"),
                     F.to_json(F.struct(*doc.columns)).alias("document"))
    publish(row, path, key, "run document", column=RUN_COLUMN)
    return attempt


def withdraw_document(spark: SparkSession, path: str, job: str, run_date: str) -> None:
    """Take the document of a run out of the table, as that of a failure once the run has been repeated with success."""
    key = _run_key(job, run_date)
    if key in current(spark, path).partitions:
        commit(spark, path, lambda state: state.partitions.pop(key, None) and None)


def current_documents(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """(job, run_date, attempt, document): the current document of every run, as JSON text, or parsed by ``schema``."""
    df = read_table(spark, path, DOCUMENTS_SCHEMA, RUN_COLUMN)
    df = (df if df is not None else spark.createDataFrame([], DOCUMENTS_SCHEMA)).select(*DOCUMENTS_SCHEMA.fieldNames())
    return df if schema is None else df.withColumn("document", F.from_json("document", schema))


def report_to_kv(report: DataFrame, report_col: str = "report", keys: list[str] | None = None) -> DataFrame:
    """Parse a key/value text report column into rows (see functions.report)."""
    from tessera.functions.report import report_lines
    keys = keys or []
    return parse_kv_lines(report_lines(report, report_col, keys), keys)


def metrics_json(doc: DataFrame) -> str:
    """The one-row run document as a JSON string."""
    return doc.select(F.to_json(F.struct(*doc.columns))).first()[0]


def save_metrics(kind: str, path: str, *, spark: SparkSession | None = None,
                 error: BaseException | str | None = None, df: DataFrame | None = None,
                 metrics_data: DataFrame | dict | str | None = None, owner: Owner | None = None) -> None:
    """Append a success or failure document.

    ``kind`` is 'success' (needs ``metrics_data``: a one-row DataFrame, a
    dict or a JSON string) or 'fail' (needs ``error``; ``df`` gives the
    client segments).
    """
    kind = (kind or "").lower()
    if kind not in ("success", "fail"):
        raise ValueError("kind must be 'success' or 'fail'")
    if kind == "fail":
        if not error:
            raise ValueError("a 'fail' document needs an error")
        if spark is None:
            raise ValueError("a session is needed for a failure document")
        append_document(failure_document(spark, error, df, owner), path)
        return
    if metrics_data is None or (isinstance(metrics_data, (str, dict)) and not metrics_data):
        raise ValueError("a 'success' document needs metrics_data")
    append_document(metrics_data, path, spark)
