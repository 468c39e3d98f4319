"""Merge + checks + split: the validation stage of the silver job.

Decisions where the replaced job was ambiguous (see README):

* the duplicate check runs on the incoming batch (after the merge every id is
  unique, so a check there could never fire); it is computed by the merge's
  own per-id aggregation (``n_batch``), not by another shuffle;
* rows with a NULL id are not merged into one row; each goes to quarantine;
* a row of today's batch without a segment goes to quarantine, while ids
  seen only in history land in neither output but are counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ratings import rating_as_int
from tessera.operators import quality as q
from tessera.operators.key_filter import key_filter
from tessera.operators.normalize import normalize_reviews
from tessera.operators.snapshot import snapshot_merge
from tessera.schemas import CRITICAL_COLUMNS, INVALID_COLUMNS, VALID_REQUIRED


@dataclass
class Validated:
    checked: DataFrame     # merged rows + NULL-id rows, before the split
    valid: DataFrame       # silver schema
    invalid: DataFrame     # quarantine columns
    duplicates: DataFrame  # batch rows of duplicated ids (part of invalid)
    raw_batch: DataFrame | None = None
    held: list[DataFrame] = field(default_factory=list)  # persisted for ``checked``; the caller releases them


def checked_frame(batch: DataFrame, history: DataFrame, run_date: str | None,
                  how: str = "full_outer", filter_history: bool = False, thin_history: list[DataFrame] | None = None) -> DataFrame:
    """Merged snapshot plus the NULL-id rows of the batch, one schema."""
    merged = snapshot_merge(batch, history, run_date, how=how, filter_history=filter_history, thin_history=thin_history)
    null_ids = batch.where(F.col("id").isNull()).select(
        "id", "avatar", "app", "segmento", "rating", "iso_date", "title", "snippet", "likes",
        q.empty_history().alias("historical_data"), F.lit(True).alias("in_batch"),
        F.lit(1).cast("long").alias("n_batch"))
    return merged.unionByName(null_ids)


def duplicate_batch_rows(batch: DataFrame, checked: DataFrame, raw_batch: DataFrame | None = None, filtered: bool = False) -> DataFrame:
    """Batch rows whose id occurs more than once (semi join on the merged ids
    flagged by ``n_batch``; the flagged side is unique per id).

    With ``raw_batch`` (the batch before normalisation) the semi join runs on
    the raw rows and only the surviving duplicates are normalised, so the
    text folding is not repeated for the whole batch.  ``filtered`` is for a
    ``checked`` that is materialised already: a Bloom filter of the duplicated
    ids then drops most other rows before the join's exchange.
    """
    dup_ids = checked.where(F.col("n_batch") > 1).select("id")
    if filtered:
        passes = key_filter(dup_ids, "id")
        batch, raw_batch = (x.where(passes(F.col("id"))) if x is not None else None for x in (batch, raw_batch))
    if raw_batch is not None:
        return normalize_reviews(raw_batch.join(dup_ids, "id", "left_semi"))
    return batch.join(dup_ids, "id", "left_semi")


def validate(batch: DataFrame, history: DataFrame, run_date: str | None,
             how: str = "full_outer", raw_batch: DataFrame | None = None, filter_history: bool = False, thin_history: bool = False) -> Validated:
    """Merge, check and split one batch.  ``raw_batch`` is the same batch
    before ``normalize_reviews`` (optional; see :func:`duplicate_batch_rows`)."""
    held: list[DataFrame] = []
    checked = checked_frame(batch, history, run_date, how, filter_history, held if thin_history else None)
    dups = duplicate_batch_rows(batch, checked, raw_batch).select(*INVALID_COLUMNS)
    return Validated(
        checked=checked,
        valid=q.split_valid(checked),
        invalid=q.split_invalid(checked, dups),
        duplicates=dups,
        raw_batch=raw_batch,
        held=held,
    )


def _sum_bool(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c, 1).otherwise(0) for c in conds])


def summary_aggregates(checked: DataFrame) -> list[Column]:
    """Every counter of the run in one pass over the checked frame."""
    valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in VALID_REQUIRED])
    is_dup = F.col("id").isNotNull() & (F.col("n_batch") > 1)
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~F.col("in_batch")).alias("history_only"),
        F.count_if(is_dup).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(is_dup, F.col("n_batch"))), F.lit(0)).alias("duplicate_rows"),
        *q.null_count_columns(CRITICAL_COLUMNS),
        F.count_if(rating_as_int(F.col("rating")).isNull()).alias("invalid_ratings"),
        F.count_if(valid).alias("valid_count"),
        F.count_if(q.invalid_predicate(checked) & (F.col("n_batch") <= 1)).alias("invalid_rows"),
        F.coalesce(F.sum(F.when(F.col("in_batch"), F.col("n_batch"))), F.lit(0)).alias("batch_rows"),
        F.array_sort(F.collect_set(F.when(valid, F.coalesce(F.col("segmento"), F.lit("UNKNOWN")))))
         .alias("segments"),
        F.coalesce(F.sum(F.when(valid, _text_bytes(VALID_REQUIRED))), F.lit(0)).alias("valid_text_bytes"),
    ]


def _text_bytes(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in cols])


def quality_summary(checked: DataFrame) -> DataFrame:
    """One row of run totals, check statuses, and valid / invalid shares of the batch's rows."""
    row = checked.agg(*summary_aggregates(checked))
    null_total = reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in CRITICAL_COLUMNS])
    invalid_count = F.col("invalid_rows") + F.col("duplicate_rows")
    doc_total = F.col("valid_count") + invalid_count
    dup_ok = F.col("duplicate_keys") == 0
    null_ok = null_total == 0
    type_ok = F.col("invalid_ratings") == 0
    success = _sum_bool([dup_ok, null_ok, type_ok])

    def pct(x: Column) -> Column:
        return F.when(F.col("batch_rows") > 0, x / F.col("batch_rows") * 100).otherwise(F.lit(0.0))

    return row.select(
        "total_records", "history_only", "batch_rows", "duplicate_keys", "duplicate_rows",
        *[f"null_{c}" for c in CRITICAL_COLUMNS], "invalid_ratings",
        "valid_count", invalid_count.alias("invalid_count"), doc_total.alias("written_total"),
        pct(F.col("valid_count")).alias("pct_valid"), pct(invalid_count).alias("pct_invalid"),
        dup_ok.alias("duplicate_status"), null_ok.alias("null_status"), type_ok.alias("type_status"),
        success.alias("success_count"), (F.lit(3) - success).alias("error_count"),
        segment_list_text(F.col("segments")).alias("type_client"),
        F.col("valid_text_bytes").cast("long").alias("valid_text_bytes"), "segments",
    )


def segment_list_text(segments: Column) -> Column:
    """Distinct segments as one upper-case comma list; 'NA' when there are none."""
    return F.when(F.size(segments) > 0, F.upper(F.array_join(segments, ","))).otherwise(F.lit("NA"))


def validation_results(summary: DataFrame) -> DataFrame:
    """The three checks as rows: check, status, code, message, report."""
    s = summary
    null_msg = q.null_message({c: F.col(f"null_{c}") for c in CRITICAL_COLUMNS})
    dup_msg = q.duplicate_message(F.col("duplicate_keys"))

    def entry(name, ok, bad_code, bad_msg, ok_msg):
        return F.struct(
            F.lit(name).alias("check"), ok.alias("status"),
            F.when(ok, F.lit(q.CODE_OK)).otherwise(F.lit(bad_code)).alias("code"),
            F.when(ok, F.lit(ok_msg)).otherwise(bad_msg).alias("message"),
            q.status_report(ok).alias("report"))

    checks = F.array(
        entry(q.CHECK_DUPLICATE, F.col("duplicate_status"), q.CODE_CONFLICT, dup_msg, q.MSG_DUP_NONE),
        entry(q.CHECK_NULL, F.col("null_status"), q.CODE_BAD_DATA, null_msg, q.MSG_NULL_NONE),
        entry(q.CHECK_TYPE, F.col("type_status"), q.CODE_BAD_DATA, F.lit(q.MSG_TYPE_FOUND), q.MSG_TYPE_NONE),
    )
    return s.select(F.inline(checks))


def results_dict(summary_row: dict) -> dict:
    """The validation results as a plain dict (three checks + total_records),
    built from the one-row summary."""
    nulls = {c: summary_row[f"null_{c}"] for c in CRITICAL_COLUMNS if summary_row[f"null_{c}"] > 0}
    null_text = "{" + ", ".join(f"'{c}': {n}" for c, n in nulls.items()) + "}"

    def entry(ok: bool, bad_code: int, bad_msg: str, ok_msg: str) -> dict:
        return {"message": ok_msg if ok else bad_msg, "status": bool(ok),
                "code": q.CODE_OK if ok else bad_code}

    return {
        q.CHECK_DUPLICATE: entry(summary_row["duplicate_status"], q.CODE_CONFLICT,
                                  q.MSG_DUP_FOUND.replace("{n}", str(summary_row["duplicate_keys"])),
                                  q.MSG_DUP_NONE),
        q.CHECK_NULL: entry(summary_row["null_status"], q.CODE_BAD_DATA,
                             q.MSG_NULL_FOUND.replace("{issues}", null_text), q.MSG_NULL_NONE),
        q.CHECK_TYPE: entry(summary_row["type_status"], q.CODE_BAD_DATA, q.MSG_TYPE_FOUND, q.MSG_TYPE_NONE),
        "total_records": int(summary_row["total_records"]),
    }


def validate_ingest(batch: DataFrame, history: DataFrame, run_date: str | None = None,
                    raw_batch: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """``(valid, invalid, results)`` in one call; ``results`` comes from the
    one-row summary (the only collect)."""
    v = validate(batch, history, run_date, raw_batch=raw_batch)
    row = quality_summary(v.checked).first().asDict()
    return v.valid, v.invalid, results_dict(row)
