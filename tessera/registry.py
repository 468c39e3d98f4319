"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the test tables (or frames Spark derives from them) and
returns flat, scalar columns so that it can be compared value by value with
its SQL oracle in ``tessera.oracle``.  Nested outputs (the change history)
are rendered as a count plus an ordered string.  Queries that exercise a
source or sink write to a fresh folder under the session's checkpoint folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.paths import app_from_path, segment_from_path
from tessera.functions.text import fold_upper
from tessera.operators import normalize, quality, snapshot
from tessera.plans import run_metrics as rm
from tessera.plans import silver_job, validation
from tessera.schemas import INVALID_COLUMNS, SILVER_SCHEMA
from tessera.session import scratch_path
from tessera.sinks.files import create_text
from tessera.sinks.parquet import conform, save_partitioned
from tessera.sinks.publish import LOG, current, publish
from tessera.sources import bronze as bronze_src
from tessera.sources import fixtures as fx
from tessera.sources.drift import read_segments_drifting
from tessera.sources.history import read_history
from tessera.sources.versions import VERSIONS_SCHEMA, prepare_versions, stored_events, update

Query = Callable[[SparkSession, str], DataFrame]

MERGED_COLUMNS = ["id", "avatar", "app", "segmento", "rating", "iso_date", "title", "snippet",
                  "likes", "n_hist", "history", "in_batch", "n_batch"]
SILVER_FLAT = ["id", "app", "segmento", "rating", "iso_date", "title", "snippet", "n_hist", "history"]


def history_string(c: Column) -> Column:
    """Render a history array as 'title|snippet|app|segmento|rating|iso_date;...'."""
    return F.array_join(
        F.transform(c, lambda e: F.concat_ws(
            "|", e["title"], e["snippet"], e["app"], F.coalesce(e["segmento"], F.lit("~")),
            e["rating"], e["iso_date"])),
        ";")


def flatten_history(df: DataFrame, col: str = "historical_data") -> DataFrame:
    return (df.withColumn("n_hist", F.coalesce(F.size(col), F.lit(0)).cast("long"))
              .withColumn("history", F.coalesce(history_string(F.col(col)), F.lit("")))
              .drop(col))


def _merged(spark, sf_dir):
    return snapshot.snapshot_merge(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), fx.RUN_DATE)


def _validated(spark, sf_dir):
    raw = fx.bronze(spark, sf_dir)
    return validation.validate(normalize.normalize_reviews(raw), fx.hist(spark, sf_dir), fx.RUN_DATE,
                               raw_batch=raw)


# ------------------------------------------------------------------ sources
def q_bronze_scan(spark, sf_dir):
    base = scratch_path(spark, "bronze") + "/googlePlay"
    fx.write_bronze_layout(spark, sf_dir, base, every=True)
    df = bronze_src.read_reviews(spark, bronze_src.segment_paths(base, fx.RUN_DATE))
    return df.select("avatar", "date", "id", "iso_date", "likes", "rating", "snippet", "title",
                     "app", "segmento")


def q_segment_union(spark, sf_dir):
    base = scratch_path(spark, "bronze") + "/googlePlay"
    fx.write_bronze_layout(spark, sf_dir, base, every=True)
    df = bronze_src.read_segments(spark, base, fx.RUN_DATE)
    return df.select("avatar", "date", "id", "iso_date", "likes", "rating", "snippet", "title",
                     "app", "segmento")


def q_drifting_scan(spark, sf_dir):
    """Files with ratings as doubles, text and whole numbers, without a column, and two that are no Parquet files."""
    base = scratch_path(spark, "bronze") + "/googlePlay"
    fx.write_drifting_layout(spark, sf_dir, base)
    df, unreadable = read_segments_drifting(spark, base, fx.RUN_DATE)
    n, apps = unreadable.agg(F.count("*"), F.array_join(F.array_sort(F.collect_set(app_from_path(F.col("path")))), ",")).first()
    return df.select("avatar", "date", "id", "iso_date", "likes", "rating", "snippet", "title", "app", "segmento",
                     F.lit(n).alias("n_unreadable"), F.lit(apps).alias("unreadable_apps"))


def q_path_app_extract(spark, sf_dir):
    p = fx.bronze_paths(spark, sf_dir)
    return p.select("doc_id", "path", app_from_path(F.col("path")).alias("app"))


def q_path_segment_extract(spark, sf_dir):
    p = fx.bronze_paths(spark, sf_dir)
    return p.select("doc_id", "path", segment_from_path(F.col("path")).alias("segmento"))


def q_history_scan(spark, sf_dir):
    path = scratch_path(spark, "silver")
    fx.write_history_table(spark, sf_dir, path, late_copy_date=fx.RUN_DATE, every=True)
    return read_history(spark, path, fx.RUN_DATE)


def q_history_compact(spark, sf_dir):
    """Compacted history snapshot (distinct versions, last day seen) built
    from a written silver table and read back."""
    root = scratch_path(spark, "versions")
    fx.write_history_table(spark, sf_dir, f"{root}/silver", late_copy_date=fx.RUN_DATE, every=True)
    return prepare_versions(spark, f"{root}/versions", f"{root}/silver", fx.RUN_DATE)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _store_days(spark, sf_dir, days: list[str], root: str):
    """Write the named days of the history fixture as silver partitions."""
    h = fx.hist(spark, sf_dir, every=True)
    for day in days:
        rows = h.where(F.col("odate") == day).withColumn("historical_data", quality.empty_history())
        save_partitioned(rows.select(*[f.name for f in SILVER_SCHEMA.fields]), f"{root}/silver", day, compression=fx.CODEC)


def q_store_first_day(spark, sf_dir):
    """The store on a day without any earlier silver partition (no rows), then on the next two."""
    root = scratch_path(spark, "store-first")
    out = scratch_path(spark, "store-first-out")
    first = prepare_versions(spark, f"{root}/versions", f"{root}/silver", fx.HISTORY_DATES[0])
    first.withColumn("as_of", F.lit(fx.HISTORY_DATES[0])).write.parquet(out)
    for day, before in ((fx.HISTORY_DATES[1], [fx.HISTORY_DATES[0]]), (fx.RUN_DATE, [fx.HISTORY_DATES[1]])):
        _store_days(spark, sf_dir, before, root)
        prepare_versions(spark, f"{root}/versions", f"{root}/silver", day).withColumn("as_of", F.lit(day)).write.mode("append").parquet(out)
    return spark.read.schema(f"{_ddl(VERSIONS_SCHEMA)}, as_of string").parquet(out)


def q_store_late_partition(spark, sf_dir):
    """A partition that lands after the snapshot that should have covered it."""
    root = scratch_path(spark, "store-late")
    _store_days(spark, sf_dir, [fx.HISTORY_DATES[1]], root)
    prepare_versions(spark, f"{root}/versions", f"{root}/silver", fx.RUN_DATE)
    _store_days(spark, sf_dir, [fx.HISTORY_DATES[0]], root)
    return prepare_versions(spark, f"{root}/versions", f"{root}/silver", fx.RUN_DATE)


def q_store_rewritten_day(spark, sf_dir):
    """A covered partition that is rewritten: what only its old files held must not be served."""
    root = scratch_path(spark, "store-rewritten")
    _store_days(spark, sf_dir, list(fx.HISTORY_DATES), root)
    prepare_versions(spark, f"{root}/versions", f"{root}/silver", fx.RUN_DATE)
    fixed = fx.hist(spark, sf_dir, every=True).where(F.col("odate") == fx.HISTORY_DATES[0]).withColumns(
        {"app": F.concat(F.lit("fixed "), "app"), "historical_data": quality.empty_history()})
    save_partitioned(fixed.select(*[f.name for f in SILVER_SCHEMA.fields]), f"{root}/silver", fx.HISTORY_DATES[0], compression=fx.CODEC)
    return prepare_versions(spark, f"{root}/versions", f"{root}/silver", "20240104")


def _ten_days(spark, sf_dir) -> tuple[str, list[tuple[str, int]]]:
    """A store brought up to date on each of ten days and on the day after; the rows written each time."""
    root = scratch_path(spark, "store-ten")
    written = []
    for day, after in zip(fx.TEN_DAYS, [*fx.TEN_DAYS[1:], "20240211"]):
        rows = fx.ten_days(spark, sf_dir, (day,)).withColumn("historical_data", quality.empty_history())
        publish(rows.select(*[f.name for f in SILVER_SCHEMA.fields]), f"{root}/silver", day, compression=fx.CODEC)
        written.append((day, update(spark, f"{root}/versions", f"{root}/silver", after)))
    return root, written


def q_store_ten_days(spark, sf_dir):
    """The versions that the incremental store gives after ten days, and as of the sixth."""
    root, _ = _ten_days(spark, sf_dir)
    sixth, last = (prepare_versions(spark, f"{root}/versions", f"{root}/silver", d).withColumn("as_of", F.lit(d)) for d in ("20240206", "20240211"))
    return sixth.unionByName(last)


def q_store_daily_writes(spark, sf_dir):
    """Rows that the store wrote on each of ten days, and those it holds of that day: the changes, not the day's reviews."""
    root, written = _ten_days(spark, sf_dir)
    held = stored_events(spark, f"{root}/versions").groupBy("day").agg(F.count("*").alias("event_rows"), F.count_if("gone").alias("gone_rows"))
    wrote = spark.createDataFrame([(int(d), n) for d, n in written], "day int, rows_written long")
    return wrote.join(held, "day", "left").select("day", "rows_written", F.coalesce("event_rows", F.lit(0)).alias("event_rows"), F.coalesce("gone_rows", F.lit(0)).alias("gone_rows"))


def q_merge_no_history(spark, sf_dir):
    empty = spark.createDataFrame([], fx.hist(spark, sf_dir).schema)
    merged = snapshot.snapshot_merge(fx.norm(spark, sf_dir, every=True), empty, fx.RUN_DATE)
    return flatten_history(merged).select(*MERGED_COLUMNS)


# ------------------------------------------------------------------ projections
def q_accent_fold(spark, sf_dir):
    return fx.documents(spark, sf_dir).select("doc_id", fold_upper("text").alias("folded"))


#: Endings from every class of characters, by ``doc_id`` (what they fold to stands in ``tessera.oracle``).
WIDE_ENDINGS = [
    "1º lugar, 2ª vez", "½ ² ™ ©", "ótimo 😀👍🏽!", "ＡＢＣ１２", "Хорошо, спасибо", "Ελλάδα", "हिन्दी", "ภาษาไทยดี",
    "e\u0301te\u0302 n\u0303", "ﬁm de “aspas” – já…", "25° ±1 €5", "plain",
]


def q_accent_fold_wide(spark, sf_dir):
    """Folding of every document with an ending from one class of characters."""
    endings = F.array(*[F.lit(e) for e in WIDE_ENDINGS])
    ending = F.element_at(endings, (F.col("doc_id") % len(WIDE_ENDINGS) + 1).cast("int"))
    return fx.documents(spark, sf_dir).select("doc_id", fold_upper(F.concat_ws(" ", "text", ending)).alias("folded"))


def q_rating_truncate(spark, sf_dir):
    b = fx.bronze_with_doc(spark, sf_dir, every=True).select("doc_id", "id", "iso_date", F.col("rating").alias("rating_in"))
    return normalize.rating_truncate(b.withColumn("rating", F.col("rating_in")))


def q_normalize_reviews(spark, sf_dir):
    return fx.norm(spark, sf_dir, every=True)


def q_schema_conform(spark, sf_dir):
    """Integers and doubles come out as the schema's strings; the types are part of the result."""
    checked = validation.checked_frame(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), fx.RUN_DATE)
    typed = checked.withColumns({"id": F.col("id").cast("long"), "rating": F.col("rating").cast("int"),
                                 "app": F.length("app") + F.lit(0.5).cast("double")})
    out = conform(typed, SILVER_SCHEMA)
    types = [F.typeof(c).alias(f"{c}_type") for c in ("id", "rating", "app")]
    return flatten_history(out.select("*", *types)).select(*SILVER_FLAT, "id_type", "rating_type", "app_type")


def q_sample_preview(spark, sf_dir):
    v = _validated(spark, sf_dir).valid
    return flatten_history(v.orderBy("id").limit(10)).select(*SILVER_FLAT)


# ------------------------------------------------------------------ joins / merge
def q_history_full_outer(spark, sf_dir):
    return snapshot.history_join(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), "full_outer", fx.RUN_DATE)


def q_history_left_outer(spark, sf_dir):
    return snapshot.history_join(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), "left_outer", fx.RUN_DATE)


def q_history_left_filtered(spark, sf_dir):
    """The left outer merge with a Bloom filter of the batch's ids on the history scan."""
    merged = snapshot.snapshot_merge(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), fx.RUN_DATE, "left_outer", filter_history=True)
    return flatten_history(merged).select(*MERGED_COLUMNS)


def q_salted_history_join(spark, sf_dir):
    return snapshot.salted_history_join(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), run_date=fx.RUN_DATE)


def _one_hot(spark, sf_dir):
    """The history with every third document's versions under one id, of which each is a version of its own."""
    doc_id = F.col("id").cast("long")
    hot = doc_id % 3 == 0
    return fx.hist(spark, sf_dir, every=True).withColumns({
        "title": F.when(hot, F.concat("title", F.lit(" "), "id")).otherwise(F.col("title")), "id": F.when(hot, F.lit("1")).otherwise(F.col("id"))})


def q_salted_hot_id(spark, sf_dir):
    """The salted join with one id that holds a third of the versions, more than a task may take."""
    return snapshot.salted_history_join(fx.norm(spark, sf_dir, every=True), _one_hot(spark, sf_dir), 20, fx.RUN_DATE)


def q_heavy_hitters(spark, sf_dir):
    """The ids that the sketch would salt: the hot one, and no other."""
    versions = snapshot.history_versions(_one_hot(spark, sf_dir), fx.RUN_DATE)
    return snapshot.heavy_hitters(versions, "id", 20).select("id", (F.col("salts") > 1).alias("salted"))


def q_change_detection(spark, sf_dir):
    return snapshot.change_detection(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), fx.RUN_DATE)


def q_snapshot_merge(spark, sf_dir):
    return flatten_history(_merged(spark, sf_dir)).select(*MERGED_COLUMNS)


def q_history_collect(spark, sf_dir):
    changes = snapshot.change_detection(fx.norm(spark, sf_dir), fx.hist(spark, sf_dir), fx.RUN_DATE)
    collected = snapshot.collect_history(changes)
    return flatten_history(collected).select("id", "n_hist", "history")


def q_history_explode(spark, sf_dir):
    e = quality.history_explode(_merged(spark, sf_dir).select("id", "historical_data"))
    return e.select("id", *[F.col(f"entry.{c}").alias(c)
                            for c in ["title", "snippet", "app", "segmento", "rating", "iso_date"]])


def q_history_regroup(spark, sf_dir):
    """Every valid row comes twice and fuses into one with both histories."""
    valid = _validated(spark, sf_dir).valid
    twice = valid.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return flatten_history(quality.history_regroup(twice)).select(*SILVER_FLAT)


def q_history_empty_normalise(spark, sf_dir):
    """Histories of even ids are null, of other ids as merged (some empty); none may be null afterwards."""
    m = _merged(spark, sf_dir).withColumn("historical_data", F.when(F.col("id").cast("long") % 2 != 0, F.col("historical_data")))
    m = quality.history_empty_normalise(m.select("id", "historical_data"))
    return flatten_history(m.withColumn("has_array", F.col("historical_data").isNotNull())).select("id", "n_hist", "history", "has_array")


# ------------------------------------------------------------------ checks
def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(fx.norm(spark, sf_dir, every=True))


def q_duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(fx.norm(spark, sf_dir, every=True))


def q_duplicate_check(spark, sf_dir):
    return quality.duplicate_check(fx.norm(spark, sf_dir, every=True))


def q_null_counts(spark, sf_dir):
    return quality.null_counts(fx.norm(spark, sf_dir, every=True))


def q_null_check(spark, sf_dir):
    return quality.null_check(_validated(spark, sf_dir).checked)


def q_type_check(spark, sf_dir):
    return quality.type_check(fx.raw_ratings(spark, sf_dir), "rating_raw")


def q_split_valid(spark, sf_dir):
    return flatten_history(_validated(spark, sf_dir).valid).select(*SILVER_FLAT)


def q_split_invalid(spark, sf_dir):
    return _validated(spark, sf_dir).invalid.select(*INVALID_COLUMNS)


def q_quality_summary(spark, sf_dir):
    return validation.quality_summary(_validated(spark, sf_dir).checked).drop("valid_text_bytes", "segments")


def q_validation_results(spark, sf_dir):
    summary = validation.quality_summary(_validated(spark, sf_dir).checked)
    return validation.validation_results(summary)


def q_segment_list(spark, sf_dir):
    summary = validation.quality_summary(_validated(spark, sf_dir).checked)
    return summary.select("type_client")


def q_table_size_profile(spark, sf_dir):
    return quality.size_profile(fx.hist(spark, sf_dir, every=True), ["odate", "segmento"])


# ------------------------------------------------------------------ sinks / job
def _run_job(spark, sf_dir, runs: int = 2, extra_dates: tuple[str, ...] = ()):
    base = scratch_path(spark, "job")
    cfg = silver_job.JobConfig(
        bronze_base=f"{base}/bronze/googlePlay", silver_path=f"{base}/silver",
        quarantine_path=f"{base}/quarantine", run_date=fx.RUN_DATE,
        audit_path=f"{base}/audit/metrics", failure_path=f"{base}/audit/failures")
    fx.write_bronze_layout(spark, sf_dir, cfg.bronze_base, fx.RUN_DATE, extra_dates)
    fx.write_history_table(spark, sf_dir, cfg.silver_path, late_copy_date=None)
    for _ in range(runs):  # the rerun must be idempotent
        silver_job.run(spark, cfg)
    return cfg


def q_silver_roundtrip(spark, sf_dir):
    cfg = _run_job(spark, sf_dir)
    back = silver_job.read_back(spark, cfg.silver_path)
    return flatten_history(back).select(*SILVER_FLAT, "odate")


def q_quarantine_roundtrip(spark, sf_dir):
    cfg = _run_job(spark, sf_dir)
    back = silver_job.read_back(spark, cfg.quarantine_path, silver_job.QUARANTINE_SCHEMA)
    return back.select(*INVALID_COLUMNS, "odate")


def q_rerun_empty_quarantine(spark, sf_dir):
    """A day's quarantine of two days rewritten without rows: the other day's stay, the day itself is empty."""
    path = scratch_path(spark, "rerun") + "/quarantine"
    invalid = _validated(spark, sf_dir).invalid.select(*INVALID_COLUMNS)
    kept = save_partitioned(invalid, path, "20240102", "invalid")
    save_partitioned(invalid, path, fx.RUN_DATE, "invalid")
    again = save_partitioned(invalid.limit(0), path, fx.RUN_DATE, "invalid")
    back = silver_job.read_back(spark, path, silver_job.QUARANTINE_SCHEMA)
    return back.select(*INVALID_COLUMNS, "odate", F.lit(kept).alias("rows_kept"), F.lit(again).alias("rows_again"))


def q_publish_failed_write(spark, sf_dir):
    """A published partition after a write that fails on its last review, a record that breaks off, and a commit of another day."""
    path = scratch_path(spark, "publish") + "/silver"
    rows = fx.hist(spark, sf_dir, every=True).withColumn("historical_data", quality.empty_history()).persist()
    first, second = (rows.where(F.col("odate") == d).select(*[f.name for f in SILVER_SCHEMA.fields]) for d in fx.HISTORY_DATES)
    publish(first, path, fx.HISTORY_DATES[0])
    last = rows.agg(F.max(F.col("id").cast("long"))).first()[0]
    broken = second.withColumn("title", F.when(F.col("id") == str(last), F.raise_error(F.lit("broken review")).cast("string")).otherwise(F.col("title")))
    failed = False
    try:
        publish(broken, path, fx.HISTORY_DATES[0])
    except Exception as err:
        failed = "broken review" in str(err)
    create_text(spark, f"{path}/{LOG}/{current(spark, path).number + 1:012d}.json", "0000\n{")
    publish(second, path, fx.HISTORY_DATES[1])
    rows.unpersist()
    return flatten_history(silver_job.read_back(spark, path)).select(*SILVER_FLAT, "odate", F.lit(failed).alias("write_failed"))


def q_publish_over_plain(spark, sf_dir):
    """Two plain partitions, one of them published anew with other apps: the other stays as it is."""
    path = scratch_path(spark, "publish") + "/silver"
    fx.write_history_table(spark, sf_dir, path, late_copy_date=None, every=True)
    fixed = fx.hist(spark, sf_dir, every=True).where(F.col("odate") == fx.HISTORY_DATES[1]).withColumns(
        {"app": F.concat(F.lit("fixed "), "app"), "historical_data": quality.empty_history()})
    publish(fixed.select(*[f.name for f in SILVER_SCHEMA.fields]), path, fx.HISTORY_DATES[1])
    return read_history(spark, path, fx.RUN_DATE)


def q_job_valid(spark, sf_dir):
    cfg = _run_job(spark, sf_dir, runs=1)
    back = silver_job.read_back(spark, cfg.silver_path).where(F.col("odate") == fx.RUN_DATE)
    return flatten_history(back).select(*SILVER_FLAT)


def q_silver_next_day(spark, sf_dir):
    """Day N's silver output is history on day N+1: run the job on two
    consecutive days (same bronze content) and read back day N+1."""
    cfg = _run_job(spark, sf_dir, runs=1, extra_dates=("20240104",))
    cfg.run_date = "20240104"
    silver_job.run(spark, cfg)
    back = silver_job.read_back(spark, cfg.silver_path).where(F.col("odate") == "20240104")
    return flatten_history(back).select(*SILVER_FLAT)


def q_job_invalid(spark, sf_dir):
    cfg = _run_job(spark, sf_dir, runs=1)
    back = silver_job.read_back(spark, cfg.quarantine_path, silver_job.QUARANTINE_SCHEMA).where(F.col("odate") == fx.RUN_DATE)
    return back.select(*INVALID_COLUMNS)


def q_run_metrics_doc(spark, sf_dir):
    summary = validation.quality_summary(_validated(spark, sf_dir).checked)
    clock = rm.RunClock(datetime(2024, 1, 3, 1, tzinfo=timezone.utc), datetime(2024, 1, 3, 1, 1, 30, tzinfo=timezone.utc))
    path = scratch_path(spark, "audit")
    doc = rm.metrics_document(summary, application_id="app", source_app="silver_reviews", clock=clock)
    rm.append_document(doc, path)
    # The same document again as indented JSON text: both read back alike.
    rm.append_document(json.dumps(json.loads(spark.read.text(path).first()[0]), indent=2), path, spark)
    doc = spark.read.json(path)
    return doc.select(
        F.col("valid_data.count").alias("valid_count"),
        F.col("valid_data.percentage").alias("valid_pct"),
        F.col("invalid_data.count").alias("invalid_count"),
        F.col("invalid_data.percentage").alias("invalid_pct"),
        "total_records", "checked_records", "success_count", "error_count", "type_client",
        *[F.col(f"validation_results.{c}.{f}").alias(f"{c}_{f}")
          for c in (quality.CHECK_DUPLICATE, quality.CHECK_NULL, quality.CHECK_TYPE)
          for f in ("status", "code", "message")],
        F.col("source.app").alias("source_app"), "total_processing_time",
    )


def q_run_documents_current(spark, sf_dir):
    """A day that fails once and is then run three times, and the day before that fails twice: one current document for each."""
    cfg = _run_job(spark, sf_dir, runs=0)
    for date, how, runs in ((fx.HISTORY_DATES[1], "sideways", 2), (fx.RUN_DATE, "sideways", 1), (fx.RUN_DATE, "full_outer", 3)):
        cfg.run_date, cfg.merge_how = date, how
        for _ in range(runs):
            try:
                silver_job.run(spark, cfg)
            except ValueError as err:
                assert "join type" in str(err)
    done = rm.current_documents(spark, cfg.audit_path, StructType.fromDDL("valid_data struct<count: long>, invalid_data struct<count: long>, type_client string"))
    failed = rm.current_documents(spark, cfg.failure_path, StructType.fromDDL("error string"))
    key = ["run_date", "attempt"]
    return done.select(F.lit("done").alias("kind"), *key, F.col("document.valid_data.count").alias("valid_count"), F.col("document.invalid_data.count").alias("invalid_count"),
                       "document.type_client", F.lit(None).cast("string").alias("error")).unionByName(
        failed.select(F.lit("failed").alias("kind"), *key, "document.error"), allowMissingColumns=True)


def q_failure_doc(spark, sf_dir):
    """Two failure documents, written and read back: of a readable batch, and of one that cannot be read."""
    path = scratch_path(spark, "failures")
    batch = fx.norm(spark, sf_dir, every=True)
    broken = batch.withColumn("segmento", F.raise_error(F.lit("unreadable")).cast("string"))
    for client in (batch, broken):
        rm.save_metrics("fail", path, spark=spark, error="bronze scan failed: no segment folder", df=client)
    return spark.read.json(path).select("layer", "project", "job", "priority", "tower",
                                        F.array_join("client", ",", "none").alias("client"), "error")


def q_kv_report_parse(spark, sf_dir):
    docs = fx.documents(spark, sf_dir)
    return rm.report_to_kv(docs, "text", ["doc_id"])


def all_queries() -> dict[str, Query]:
    return {
        # sources
        "bronze_scan": q_bronze_scan,
        "segment_union": q_segment_union,
        "drifting_scan": q_drifting_scan,
        "path_app_extract": q_path_app_extract,
        "path_segment_extract": q_path_segment_extract,
        "history_scan": q_history_scan,
        "history_compact": q_history_compact,
        "store_first_day": q_store_first_day,
        "store_late_partition": q_store_late_partition,
        "store_rewritten_day": q_store_rewritten_day,
        "store_ten_days": q_store_ten_days,
        "store_daily_writes": q_store_daily_writes,
        "merge_no_history": q_merge_no_history,
        # projections
        "accent_fold": q_accent_fold,
        "accent_fold_wide": q_accent_fold_wide,
        "rating_truncate": q_rating_truncate,
        "normalize_reviews": q_normalize_reviews,
        "schema_conform": q_schema_conform,
        "sample_preview": q_sample_preview,
        # joins / merge
        "history_full_outer": q_history_full_outer,
        "history_left_outer": q_history_left_outer,
        "history_left_filtered": q_history_left_filtered,
        "salted_history_join": q_salted_history_join,
        "salted_hot_id": q_salted_hot_id,
        "heavy_hitters": q_heavy_hitters,
        "change_detection": q_change_detection,
        "snapshot_merge": q_snapshot_merge,
        "history_collect": q_history_collect,
        "history_explode": q_history_explode,
        "history_regroup": q_history_regroup,
        "history_empty_normalise": q_history_empty_normalise,
        # checks
        "duplicate_keys": q_duplicate_keys,
        "duplicate_rows": q_duplicate_rows,
        "duplicate_check": q_duplicate_check,
        "null_counts": q_null_counts,
        "null_check": q_null_check,
        "type_check": q_type_check,
        "split_valid": q_split_valid,
        "split_invalid": q_split_invalid,
        "quality_summary": q_quality_summary,
        "validation_results": q_validation_results,
        "segment_list": q_segment_list,
        "table_size_profile": q_table_size_profile,
        # sinks / job / run documents
        "silver_roundtrip": q_silver_roundtrip,
        "quarantine_roundtrip": q_quarantine_roundtrip,
        "rerun_empty_quarantine": q_rerun_empty_quarantine,
        "publish_failed_write": q_publish_failed_write,
        "publish_over_plain": q_publish_over_plain,
        "job_valid": q_job_valid,
        "job_invalid": q_job_invalid,
        "silver_next_day": q_silver_next_day,
        "run_metrics_doc": q_run_metrics_doc,
        "run_documents_current": q_run_documents_current,
        "failure_doc": q_failure_doc,
        "kv_report_parse": q_kv_report_parse,
    }
