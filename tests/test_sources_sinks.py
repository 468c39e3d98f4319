import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import run_metrics as rm
from tessera.plans import silver_job
from tessera.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tessera.sinks.parquet import conform, save_partitioned
from tessera.sources.bronze import read_reviews, read_segments
from tessera.sources.history import history_exists, read_history
from tests.conftest import SF001, SF01
from tests.test_quality import BRONZE_ROWS


def test_lineage_outside_the_layout_is_blank(spark, tmp_dir):
    """A folder that is not named like an app and a segment: rows come, the two path columns are ''."""
    spark.createDataFrame(BRONZE_ROWS, BRONZE_SCHEMA).write.parquet(f"{tmp_dir}/loose")
    rows = read_reviews(spark, f"{tmp_dir}/loose").collect()
    assert sorted(r.id for r in rows) == ["r-10", "r-11", "r-12"] and all(r.app == r.segmento == "" for r in rows)
    assert "response" not in rows[0].asDict()


def test_missing_and_empty_sources(spark, tmp_dir):
    assert read_reviews(spark, f"{tmp_dir}/nope") is None
    assert read_reviews(spark, f"{tmp_dir}/nope/*_pf/odate=1/") is None
    empty = f"{tmp_dir}/empty"
    spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(empty)
    assert read_reviews(spark, empty) is None
    out = read_segments(spark, f"{tmp_dir}/googlePlay", "20240101")
    assert out.count() == 0 and {"app", "segmento"} <= set(out.columns)


def test_layout_lineage_and_one_missing_segment(spark, tmp_dir):
    base = f"{tmp_dir}/googlePlay"
    rows = spark.createDataFrame(BRONZE_ROWS, BRONZE_SCHEMA).drop("response")
    rows.write.parquet(f"{base}/bank_pf/odate=20240101")
    rows.write.parquet(f"{base}/my_app_pf/odate=20240101")
    rows.write.parquet(f"{base}/bank_pf/odate=20231231")  # other day: not read
    df = read_segments(spark, base, "20240101")
    got = sorted({(r.app, r.segmento) for r in df.collect()})
    assert got == [("bank_pf", "pf"), ("my_app_pf", "")]
    assert df.count() == 2 * len(BRONZE_ROWS)


def test_history_cutoff_is_a_partition_filter(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    assert not history_exists(spark, path)
    assert read_history(spark, path, "20240103").count() == 0
    base = spark.createDataFrame([("1", "a", "pf", "3", "d", "t", "s")],
                                 "id string, app string, segmento string, rating string, iso_date string, "
                                 "title string, snippet string").withColumn("historical_data", F.array().cast(
                                     SILVER_SCHEMA["historical_data"].dataType))
    for d in ("20240101", "20240102", "20240103"):
        save_partitioned(base, path, d, schema=SILVER_SCHEMA)
    h = read_history(spark, path, "20240103")
    assert sorted(r.odate for r in h.collect()) == ["20240101", "20240102"]
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(odate" in plan and "(odate#" in plan and "< 20240103" in plan
    assert "historical_data" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_overwrite_keeps_other_days(spark, tmp_dir):
    path = f"{tmp_dir}/out"
    df = spark.range(5).select(F.col("id").cast("string").alias("id"))
    assert save_partitioned(df, path, "20240101") == 5
    assert save_partitioned(df.limit(2), path, "20240102") == 2
    assert save_partitioned(df.limit(3), path, "20240101") == 3  # rerun of day 1
    back = spark.read.schema("id string, odate string").parquet(path).groupBy("odate").count().collect()
    assert {r.odate: r["count"] for r in back} == {"20240101": 3, "20240102": 2}
    assert save_partitioned(df.limit(0), path, "20240103") == 0
    assert save_partitioned(df.limit(0), path, "20240101") == 0  # a rerun without rows leaves none of the earlier ones
    assert [r.odate for r in spark.read.schema("id string, odate string").parquet(path).collect()] == ["20240102"] * 2


def test_sink_guards_and_conform(spark, tmp_dir):
    with pytest.raises(TypeError):
        save_partitioned("not a frame", f"{tmp_dir}/x", "20240101")
    with pytest.raises(ValueError):
        save_partitioned(spark.range(1), "", "20240101")
    df = spark.createDataFrame([(1, "a", "pf", 3.0)], "id int, app string, segmento string, rating double")
    from pyspark.sql.types import StringType, StructField, StructType
    s = StructType([StructField(n, StringType()) for n in ("rating", "id", "app")])
    out = conform(df, s)
    assert out.columns == ["rating", "id", "app"] and out.first().asDict() == {"rating": "3.0", "id": "1", "app": "a"}


def test_job_end_to_end_and_rerun(spark, tmp_dir):
    from tessera.sources import fixtures as fx
    cfg = silver_job.JobConfig(
        bronze_base=f"{tmp_dir}/bronze/googlePlay", silver_path=f"{tmp_dir}/silver",
        quarantine_path=f"{tmp_dir}/quarantine", run_date=fx.RUN_DATE, env="pre",
        audit_path=f"{tmp_dir}/audit/ok", failure_path=f"{tmp_dir}/audit/fail")
    fx.write_bronze_layout(spark, SF001, cfg.bronze_base)
    fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
    r1 = silver_job.run(spark, cfg)
    r2 = silver_job.run(spark, cfg)
    assert r1.valid_rows == r2.valid_rows > 0 and r1.invalid_rows == r2.invalid_rows > 0
    assert len(r1.preview_valid) == 10
    silver = silver_job.read_back(spark, cfg.silver_path)
    counts = {r.odate: r["count"] for r in silver.groupBy("odate").count().collect()}
    assert counts[fx.RUN_DATE] == r1.valid_rows and set(counts) == {"20240101", "20240102", fx.RUN_DATE}
    docs = rm.current_documents(spark, cfg.audit_path).collect()
    assert [(d.job, d.run_date, d.attempt) for d in docs] == [(cfg.source_app, fx.RUN_DATE, 2)]  # one document, of the second run
    doc = json.loads(docs[0].document)
    assert doc["valid_data"]["count"] == r1.valid_rows
    assert set(doc["validation_results"]) == {"duplicate_check", "null_check", "type_consistency_check"}
    # snappy-compressed, date-partitioned files
    files = silver_job.read_back(spark, cfg.silver_path).inputFiles()
    assert files and all(".snappy.parquet" in f and "/odate=" in f for f in files)


def test_job_failure_writes_failure_document(spark, tmp_dir):
    blocker = f"{tmp_dir}/not_a_folder"
    with open(blocker, "w") as f:
        f.write("x")
    cfg = silver_job.JobConfig(
        bronze_base=f"{tmp_dir}/bronze", silver_path=f"{tmp_dir}/silver", quarantine_path=blocker,
        run_date="20240103", failure_path=f"{tmp_dir}/fail")
    spark.createDataFrame(BRONZE_ROWS, BRONZE_SCHEMA).drop("response").write.parquet(
        f"{tmp_dir}/bronze/x_pf/odate=20240103")
    with pytest.raises(Exception):
        silver_job.run(spark, cfg)  # the quarantine write fails: its path is a file
    docs = [json.loads(d.document) for d in rm.current_documents(spark, cfg.failure_path).collect()]
    # the batch was read, so the client list holds its segments ('' outside the googlePlay layout)
    assert len(docs) == 1 and docs[0]["layer"] == "silver" and docs[0]["client"] == [""]
    with pytest.raises(Exception):
        silver_job.run(spark, cfg)
    assert [d.attempt for d in rm.current_documents(spark, cfg.failure_path).collect()] == [2]
    cfg.quarantine_path = f"{tmp_dir}/quarantine"
    silver_job.run(spark, cfg)  # the failure is taken back
    assert rm.current_documents(spark, cfg.failure_path).count() == 0
    # an error before any data is read reports the unknown client
    bad = silver_job.JobConfig(bronze_base=f"{tmp_dir}/bronze", silver_path="", quarantine_path=f"{tmp_dir}/q2",
                               run_date="20240103", failure_path=f"{tmp_dir}/fail2")
    with pytest.raises(Exception):
        silver_job.run(spark, bad)
    assert json.loads(rm.current_documents(spark, bad.failure_path).first().document)["client"] == ["UNKNOWN_CLIENT"]


def test_metrics_sink_arguments(spark, tmp_dir):
    with pytest.raises(ValueError):
        rm.append_document("{not json", f"{tmp_dir}/m", spark)
    with pytest.raises(ValueError):
        rm.failure_document(spark, "")
    rm.append_document({"a": 1}, f"{tmp_dir}/m", spark)
    rm.append_document(json.dumps({"a": 2}, indent=4), f"{tmp_dir}/m", spark)
    assert sorted(r.a for r in spark.read.json(f"{tmp_dir}/m").collect()) == [1, 2]
    with pytest.raises(ValueError):
        rm.append_document("[1]", f"{tmp_dir}/m", spark)


def test_documents_of_several_runs(spark, tmp_dir):
    doc = spark.range(1).select(F.lit(3).alias("n"), F.lit("é").alias("t"))
    names = [("a", "20240101"), ("a b", "20240101"), ("a_b", "20240101"), ("a", "20240102")]
    assert [rm.upsert_document(doc, tmp_dir, *n) for n in names] == [1, 1, 1, 1] and rm.upsert_document(doc.withColumn("n", F.lit(4)), tmp_dir, *names[1]) == 2
    found = {(r.job, r.run_date): (r.attempt, r.document.n, r.document.t) for r in rm.current_documents(spark, tmp_dir, doc.schema).collect()}
    assert found == {n: (2, 4, "é") if n == names[1] else (1, 3, "é") for n in names}
    rm.withdraw_document(spark, tmp_dir, *names[0])
    rm.withdraw_document(spark, tmp_dir, "other", "20240101")
    assert rm.current_documents(spark, tmp_dir).count() == 3
    with pytest.raises(ValueError):
        rm.upsert_document(doc, "", "a", "b")


def test_a_run_document_needs_the_run_clock(spark):
    with pytest.raises(ValueError):
        rm.metrics_document(spark.range(1), application_id="a", source_app="s")


def test_failure_document_clients(spark):
    rows = spark.createDataFrame([("pj",), (None,), ("pf",), ("pj",)], "segmento string")
    assert rm.failure_document(spark, "x", rows).first().client == ["pf", "pj", None]
    broken = rows.withColumn("segmento", F.raise_error(F.lit("lost")).cast("string"))
    for client in (None, [], rows.drop("segmento"), broken):
        assert rm.failure_document(spark, "x", client).first().client == ["UNKNOWN_CLIENT"]


@pytest.mark.parametrize("run_date", ["2024-01-03", "20240230", "", "20240103 "])
def test_run_date_is_checked(spark, tmp_dir, run_date):
    cfg = silver_job.JobConfig(bronze_base=tmp_dir, silver_path=f"{tmp_dir}/s", quarantine_path=f"{tmp_dir}/q", run_date=run_date)
    with pytest.raises(ValueError):
        silver_job.run(spark, cfg)
    assert not os.path.exists(f"{tmp_dir}/q")


@pytest.mark.parametrize("fails", [False, True])
def test_a_run_holds_no_texts_in_memory_and_leaves_no_files(spark, tmp_dir, monkeypatch, fails):
    """Nothing that has a text column is persisted, by the run or by its layouts; the run's own files go, also if it fails."""
    from tessera.sinks.files import listing
    from tessera.sources import fixtures as fx
    cfg = silver_job.JobConfig(
        bronze_base=f"{tmp_dir}/bronze/googlePlay", silver_path=f"{tmp_dir}/silver",
        quarantine_path=f"{tmp_dir}/quarantine", run_date=fx.RUN_DATE)
    persisted, frame = [], type(spark.range(1))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: (persisted.append(self.columns), persist(self, *a))[1])
    fx.write_bronze_layout(spark, SF001, cfg.bronze_base)
    fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
    if fails:
        monkeypatch.setattr(silver_job, "quality_summary", lambda checked: checked.select(F.raise_error(F.lit("summary"))))
        with pytest.raises(Exception, match="summary"):
            silver_job.run(spark, cfg)
    else:
        assert silver_job.run(spark, cfg).valid_rows > 0
    assert not [c for c in persisted if "snippet" in c]
    assert listing(spark, f"{cfg.silver_path}/{silver_job.WORK}") == []


def test_files_of_broken_runs_are_removed_later(spark, tmp_dir, monkeypatch):
    cfg = silver_job.JobConfig(bronze_base=tmp_dir, silver_path=f"{tmp_dir}/s", quarantine_path=f"{tmp_dir}/q", run_date="20240103")
    left = silver_job.work_folder(spark, cfg)
    spark.range(3).write.parquet(left)
    silver_job.work_folder(spark, cfg)
    assert os.path.exists(left)
    monkeypatch.setattr(silver_job, "ABANDONED_S", -60)
    silver_job.work_folder(spark, cfg)
    assert not os.path.exists(left)


def test_job_kept_in_files_equals_persisted(spark, tmp_dir):
    from tessera.sources import fixtures as fx
    outs = {}
    for mode in ("files", "persist"):
        cfg = silver_job.JobConfig(
            bronze_base=f"{tmp_dir}/{mode}/bronze/googlePlay", silver_path=f"{tmp_dir}/{mode}/silver",
            quarantine_path=f"{tmp_dir}/{mode}/quarantine", run_date=fx.RUN_DATE, materialize=mode)
        fx.write_bronze_layout(spark, SF001, cfg.bronze_base)
        fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
        r = silver_job.run(spark, cfg)
        outs[mode] = r.summary, silver_job.read_back(spark, cfg.silver_path), silver_job.read_back(spark, cfg.quarantine_path, silver_job.QUARANTINE_SCHEMA)
    (a, silver_a, bad_a), (b, silver_b, bad_b) = outs["files"], outs["persist"]
    assert a == b
    for x, y in ((silver_a, silver_b), (bad_a, bad_b)):
        assert x.schema == y.schema and x.count() == y.count() > 0
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_job_with_checkpointed_merge_equals_persisted(spark, tmp_dir):
    from tessera.sources import fixtures as fx
    outs = {}
    for mode in ("persist", "checkpoint"):
        cfg = silver_job.JobConfig(
            bronze_base=f"{tmp_dir}/{mode}/bronze/googlePlay", silver_path=f"{tmp_dir}/{mode}/silver",
            quarantine_path=f"{tmp_dir}/{mode}/quarantine", run_date=fx.RUN_DATE, materialize=mode)
        fx.write_bronze_layout(spark, SF001, cfg.bronze_base)
        fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
        r = silver_job.run(spark, cfg)
        outs[mode] = (r.valid_rows, r.invalid_rows, r.summary)
    assert outs["persist"] == outs["checkpoint"]


def test_next_day_with_unchanged_input_reproduces_silver(spark, tmp_dir):
    """Day N's silver output becomes history on day N+1; the same bronze on
    the next day yields the same silver rows (no spurious changes)."""
    from tessera.sources import fixtures as fx
    cfg = silver_job.JobConfig(
        bronze_base=f"{tmp_dir}/bronze/googlePlay", silver_path=f"{tmp_dir}/silver",
        quarantine_path=f"{tmp_dir}/quarantine", run_date=fx.RUN_DATE)
    fx.write_bronze_layout(spark, SF001, cfg.bronze_base, fx.RUN_DATE)
    fx.write_bronze_layout(spark, SF001, cfg.bronze_base, "20240104")
    fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
    silver_job.run(spark, cfg)
    cfg.run_date = "20240104"
    silver_job.run(spark, cfg)
    back = silver_job.read_back(spark, cfg.silver_path)
    cols = [c for c in back.columns if c != "odate"]
    day3 = back.where(F.col("odate") == fx.RUN_DATE).select(*cols)
    day4 = back.where(F.col("odate") == "20240104").select(*cols)
    assert day3.count() == day4.count() > 0
    assert day3.exceptAll(day4).count() == 0 and day4.exceptAll(day3).count() == 0


def test_compacted_history_store_gives_same_outputs(spark, tmp_dir):
    """Two consecutive days with and without the versions store: identical
    silver and quarantine tables; the second day adds its changes to the store."""
    from tessera.sources import fixtures as fx
    from tessera.sinks.publish import current
    tables = {}
    for mode in ("scan", "store"):
        root = f"{tmp_dir}/{mode}"
        cfg = silver_job.JobConfig(
            bronze_base=f"{root}/bronze/googlePlay", silver_path=f"{root}/silver",
            quarantine_path=f"{root}/quarantine", run_date=fx.RUN_DATE,
            versions_path=f"{root}/versions" if mode == "store" else None)
        fx.write_bronze_layout(spark, SF001, cfg.bronze_base, fx.RUN_DATE)
        fx.write_bronze_layout(spark, SF01, cfg.bronze_base, "20240104")  # a different batch on day 2
        fx.write_history_table(spark, SF001, cfg.silver_path, late_copy_date=None)
        silver_job.run(spark, cfg)
        silver_job.run(spark, cfg)  # the rerun finds the store up to date
        cfg.run_date = "20240104"
        silver_job.run(spark, cfg)
        tables[mode] = (silver_job.read_back(spark, cfg.silver_path),
                        silver_job.read_back(spark, cfg.quarantine_path, silver_job.QUARANTINE_SCHEMA))
        if mode == "store":
            assert sorted(current(spark, cfg.versions_path).properties["covered"]) == ["20240101", "20240102", fx.RUN_DATE]
    from tessera.registry import flatten_history
    for a, b in zip(tables["scan"], tables["store"]):
        if "historical_data" in a.columns:
            a, b = flatten_history(a), flatten_history(b)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_save_metrics_kinds(spark, tmp_dir):
    with pytest.raises(ValueError):
        rm.save_metrics("other", f"{tmp_dir}/a", spark=spark)
    with pytest.raises(ValueError):
        rm.save_metrics("fail", f"{tmp_dir}/a", spark=spark)
    with pytest.raises(ValueError):
        rm.save_metrics("success", f"{tmp_dir}/a", spark=spark)
    rm.save_metrics("fail", f"{tmp_dir}/f", spark=spark, error=RuntimeError("boom"))
    rm.save_metrics("success", f"{tmp_dir}/s", spark=spark, metrics_data={"valid": 1})
    assert spark.read.json(f"{tmp_dir}/f").first().error == "boom"
    assert spark.read.json(f"{tmp_dir}/s").first().valid == 1
    doc = rm.metrics_document(spark.createDataFrame([{
        "valid_count": 1, "pct_valid": 100.0, "invalid_count": 0, "pct_invalid": 0.0, "written_total": 1,
        "total_records": 1, "valid_text_bytes": 10, "duplicate_status": True, "duplicate_keys": 0,
        "null_status": True, **{f"null_{c}": 0 for c in ["id", "rating", "app", "iso_date", "title", "snippet"]},
        "type_status": True, "success_count": 3, "error_count": 0, "type_client": "PF"}]),
        application_id="a", source_app="s", clock=rm.RunClock(rm.RunClock.now(), rm.RunClock.now()))
    parsed = json.loads(rm.metrics_json(doc))
    assert parsed["valid_data"] == {"count": 1, "percentage": 100.0} and parsed["type_client"] == "PF"


def test_command_line_entry(spark, tmp_dir):
    """``python -m tessera.plans.silver_job <env> ...`` in its own process:
    exit code 0 on success (outputs written), 1 on failure."""
    import subprocess
    import sys
    from tessera.sources import fixtures as fx
    bronze = f"{tmp_dir}/bronze/googlePlay"
    fx.write_bronze_layout(spark, SF001, bronze)
    args = [sys.executable, "-m", "tessera.plans.silver_job", "prod", "--bronze", bronze,
            "--silver", f"{tmp_dir}/silver", "--quarantine", f"{tmp_dir}/quarantine",
            "--run-date", fx.RUN_DATE, "--audit", f"{tmp_dir}/audit"]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ok = subprocess.run(args, cwd=root, capture_output=True, timeout=600)
    assert ok.returncode == 0, ok.stderr[-2000:]
    assert silver_job.read_back(spark, f"{tmp_dir}/silver").count() > 0
    bad = subprocess.run(args[:6] + ["--silver", "", "--quarantine", f"{tmp_dir}/q2",
                                     "--failures", f"{tmp_dir}/fail"], cwd=root, capture_output=True, timeout=600)
    assert bad.returncode == 1
    assert rm.current_documents(spark, f"{tmp_dir}/fail").count() == 1
