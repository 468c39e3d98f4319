"""Bronze files of several types in one folder, and files that cannot be read."""

from pyspark.sql import functions as F

from tessera.plans import silver_job
from tessera.schemas import BRONZE_SCHEMA
from tessera.sinks.publish import read_table
from tessera.sources.bronze import read_segments
from tessera.sources.drift import UNREADABLE_SCHEMA, file_groups, list_files, read_drifting, read_segments_drifting
from tests.conftest import SF001
from tests.test_quality import BRONZE_ROWS


def put(spark, folder, *exprs, n=3):
    spark.range(n).selectExpr("concat('r', id) AS id", *exprs).coalesce(1).write.mode("append").parquet(folder)


def test_a_clean_folder_is_one_group_and_reads_as_ever(spark, tmp_dir):
    base = f"{tmp_dir}/googlePlay"
    for app in ("bank_pf", "shop_pj"):
        spark.createDataFrame(BRONZE_ROWS, BRONZE_SCHEMA).write.parquet(f"{base}/{app}/odate=20240101")
    assert len(file_groups(spark, list_files(spark, f"{base}/*_pf/odate=20240101/"))) == 1
    rows, lost = read_segments_drifting(spark, base, "20240101")
    plain = read_segments(spark, base, "20240101")
    assert sorted(rows.columns) == sorted(plain.columns) and lost.count() == 0
    assert sorted(map(repr, rows.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_types_are_cast_and_what_does_not_fit_is_null(spark, tmp_dir):
    put(spark, tmp_dir, "4.5D AS rating", "1L AS likes")
    put(spark, tmp_dir, "4 AS rating", "'7' AS likes")
    put(spark, tmp_dir, "'3.25' AS rating", "array(1) AS likes")
    put(spark, tmp_dir, "'good' AS rating", "map('a', 'b') AS response")
    put(spark, tmp_dir, "2.5F AS rating", "'x' AS other")
    rows, lost = read_drifting(spark, tmp_dir)
    found = {(r.rating, r.likes): r.n for r in rows.groupBy("rating", "likes").agg(F.count("*").alias("n")).collect()}
    assert found == {(4.5, 1): 3, (4.0, 7): 3, (3.25, None): 3, (None, None): 3, (2.5, None): 3} and lost.count() == 0
    assert "other" not in rows.columns and "response" not in rows.columns


def test_unreadable_files_are_listed(spark, tmp_dir):
    for k in range(6):
        put(spark, tmp_dir, "4.5D AS rating" if k % 2 else "'4' AS rating")
    spark.createDataFrame([("no parquet at all, but long enough for a footer",)], "value string").coalesce(1).write.mode("append").text(tmp_dir)
    rows, lost = read_drifting(spark, tmp_dir)
    assert rows.count() == 18
    (r,) = lost.collect()
    assert r.path.endswith(".txt") and "not a Parquet file" in r.error


def test_nothing_there(spark, tmp_dir):
    rows, lost = read_drifting(spark, f"{tmp_dir}/none")
    assert rows is None and lost.count() == 0
    spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(f"{tmp_dir}/empty")
    assert read_drifting(spark, f"{tmp_dir}/empty")[0] is None
    rows, _ = read_segments_drifting(spark, tmp_dir, "20240101")
    assert rows.count() == 0 and {"app", "segmento"} <= set(rows.columns)


def test_the_job_goes_on_and_lists_what_it_left_out(spark, tmp_dir):
    from tessera.sources import fixtures as fx
    cfg = silver_job.JobConfig(bronze_base=f"{tmp_dir}/bronze/googlePlay", silver_path=f"{tmp_dir}/silver", quarantine_path=f"{tmp_dir}/quarantine",
                               run_date=fx.RUN_DATE, unreadable_path=f"{tmp_dir}/unreadable")
    fx.write_drifting_layout(spark, SF001, cfg.bronze_base)
    done = silver_job.run(spark, cfg)
    from pyspark.sql.types import StructType
    lost = read_table(spark, cfg.unreadable_path, StructType.fromDDL(UNREADABLE_SCHEMA))
    assert done.valid_rows > 0 and lost.count() == 2 and {r.odate for r in lost.collect()} == {fx.RUN_DATE}
