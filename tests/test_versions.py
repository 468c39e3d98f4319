"""The incremental history store against full scans."""

import random
import time

from pyspark.sql import functions as F

from tessera.operators.snapshot import VERSION_COLS, history_versions
from tessera.sinks.publish import current, publish, vacuum
from tessera.sources import versions as V
from tessera.sources.history import read_history
from tessera.sources.versions import events, prepare_versions, stored_events, update

SCHEMA = "id string, app string, segmento string, rating string, iso_date string, title string, snippet string"


def day_rows(spark, rows):
    return spark.createDataFrame([(i, "app", "pf", r, "2024-01-01", t, None) for i, r, t in rows], SCHEMA)


def version_rows(df):
    return sorted((tuple(r) for r in df.select("id", *VERSION_COLS, "odate_n").collect()), key=repr)


def same_as_scan(spark, root, run_date):
    got = version_rows(prepare_versions(spark, f"{root}/versions", f"{root}/silver", run_date))
    assert got == version_rows(history_versions(read_history(spark, f"{root}/silver", run_date)))
    return got


def test_random_days_equal_the_scan(spark, tmp_dir):
    rng = random.Random(3)
    for d in range(1, 9):
        rows = [(str(i), str(rng.randrange(2)), rng.choice(["t", "u"])) for i in range(12) if rng.random() < 0.7]
        rows += [r for r in rows if rng.random() < 0.2] + [("5", "9", "second row")] * (d % 3 == 0) + [(None, "1", "t")]
        publish(day_rows(spark, rows if d != 4 else []), f"{tmp_dir}/silver", f"2024010{d}")
        same_as_scan(spark, tmp_dir, f"2024010{d + 1}")
    for run_date in ("20240101", "20240104", "20240106"):  # earlier days again
        same_as_scan(spark, tmp_dir, run_date)


def test_only_changes_are_written(spark, tmp_dir):
    rows = [(str(i), "4", "t") for i in range(100)]
    written = []
    for d, today in ((1, rows), (2, rows), (3, [("0", "5", "t"), *rows[1:]]), (4, rows[1:]), (5, rows), (6, [*rows, ("new", "1", "t")])):
        publish(day_rows(spark, today), f"{tmp_dir}/silver", f"2024010{d}")
        written.append(update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", f"2024010{d + 1}"))
    assert written == [100, 0, 1, 1, 1, 1]
    assert update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240107") == 0
    same_as_scan(spark, tmp_dir, "20240107")


def test_rewritten_removed_and_late_days(spark, tmp_dir):
    def put(day, *rows):
        publish(day_rows(spark, rows), f"{tmp_dir}/silver", day)

    put("20240101", ("1", "4", "a"), ("2", "4", "a"))
    put("20240103", ("1", "4", "b"), ("2", "4", "a"))
    same_as_scan(spark, tmp_dir, "20240110")
    put("20240102", ("1", "4", "late"))
    same_as_scan(spark, tmp_dir, "20240110")
    put("20240103", ("2", "4", "again"))
    assert all(r[4] != "b" for r in same_as_scan(spark, tmp_dir, "20240110"))
    from tessera.sinks.publish import commit
    commit(spark, f"{tmp_dir}/silver", lambda s: s.partitions.pop("20240102") and None)
    assert all(r[3] != "late" for r in same_as_scan(spark, tmp_dir, "20240110"))


def test_deltas_are_merged_at_the_size_ratio(spark, tmp_dir, monkeypatch):
    rows = [(str(i), "4", "t" * 50) for i in range(400)]
    publish(day_rows(spark, rows), f"{tmp_dir}/silver", "20240101")
    update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240102")
    for d in range(2, 5):
        publish(day_rows(spark, [(i, str(d), t) if int(i) % 50 == d else (i, r, t) for i, r, t in rows]), f"{tmp_dir}/silver", f"2024010{d}")
        monkeypatch.setattr(V, "RATIO", 1e9 if d < 4 else 0)
        update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", f"2024010{d + 1}")
        parts = sorted(current(spark, f"{tmp_dir}/versions").partitions)
        assert parts == (["base-20240101", *[f"delta-2024010{k}" for k in range(2, d + 1)]] if d < 4 else ["base-20240104"])
    same_as_scan(spark, tmp_dir, "20240105")
    vacuum(spark, f"{tmp_dir}/versions", V.PART, keep=1)
    same_as_scan(spark, tmp_dir, "20240105")


def test_plain_partitions_are_covered_too(spark, tmp_dir):
    for d in (1, 2):
        day_rows(spark, [("1", str(d), "t")]).write.parquet(f"{tmp_dir}/silver/odate=2024010{d}")
    same_as_scan(spark, tmp_dir, "20240103")
    day_rows(spark, [("1", "7", "t"), ("2", "7", "t")]).write.mode("overwrite").parquet(f"{tmp_dir}/silver/odate=20240101")
    same_as_scan(spark, tmp_dir, "20240103")


def test_a_run_that_dies_before_its_commit(spark, tmp_dir, monkeypatch):
    publish(day_rows(spark, [("1", "4", "a")]), f"{tmp_dir}/silver", "20240101")
    update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240102")
    publish(day_rows(spark, [("1", "4", "b")]), f"{tmp_dir}/silver", "20240102")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(V, "commit", die)
        try:
            update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240103")
        except RuntimeError:
            pass
    assert stored_events(spark, f"{tmp_dir}/versions").count() == 1
    same_as_scan(spark, tmp_dir, "20240103")


def test_events_of_a_review_that_goes_and_comes_back(spark):
    rows = spark.createDataFrame([("1", "a", 1), ("1", "a", 2), ("1", "b", 4), ("1", "a", 5)], "id string, title string, odate_n int")
    rows = rows.select("id", *[(F.col("title") if c == "title" else F.lit("x")).alias(c) for c in VERSION_COLS], "odate_n")
    found = sorted((r.day, r.prior, r.gone, r.title) for r in events(rows, [1, 2, 3, 4, 5, 6]).collect())
    assert found == [(1, None, False, "a"), (3, 2, True, None), (4, 3, False, "b"), (5, 4, False, "a"), (6, 5, True, None)]


def test_the_merge_exchanges_the_reviews_alone(spark, tmp_dir):
    """The store's buckets serve its window, its grouping and the merge join."""
    from tessera.operators.snapshot import snapshot_merge

    for d in (1, 2, 3):
        publish(day_rows(spark, [(str(i), str(d if i % 9 == d else 0), "t") for i in range(50)]), f"{tmp_dir}/silver", f"2024010{d}")
        update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", f"2024010{d + 1}")
    assert len(current(spark, f"{tmp_dir}/versions").partitions) >= 1
    stored = prepare_versions(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240104")
    new = day_rows(spark, [(str(i), "7", "u") for i in range(0, 60, 2)]).withColumns({"avatar": F.lit("a"), "likes": F.lit(1).cast("long")})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = snapshot_merge(new, stored, "20240104")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        full = snapshot_merge(new, read_history(spark, f"{tmp_dir}/silver", "20240104"), "20240104")
        assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0 and merged.count() == 55
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def shuffled_bytes(spark, since: int = 0) -> tuple[int, int]:
    """Bytes that tasks have written for exchanges after the event log's place ``since``; and the place reached."""
    import glob
    import json
    import time

    folder = spark.conf.get("spark.eventLog.dir").removeprefix("file://")
    time.sleep(1)  # the log is written behind
    (path,) = [p for p in glob.glob(f"{folder}/*") if spark.sparkContext.applicationId in p]
    with open(path) as log:
        log.seek(since)
        lines = log.readlines()
        ends = [json.loads(x) for x in lines if x.startswith('{"Event":"SparkListenerTaskEnd"') and x.endswith("\n")]
        return sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in ends if e.get("Task Metrics")), log.tell()


def test_texts_that_did_not_change_are_not_exchanged(spark, tmp_dir):
    rng = random.Random(5)
    rows = [(str(i), "4", "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000))) for i in range(200)]
    publish(day_rows(spark, rows), f"{tmp_dir}/silver", "20240101")
    _, at = shuffled_bytes(spark)
    update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240102")
    first, at = shuffled_bytes(spark, at)
    assert first < 1.5 * 4_000_000  # every text once, to its bucket
    publish(day_rows(spark, [("0", "5", rows[0][2]), *rows[1:]]), f"{tmp_dir}/silver", "20240102")
    _, at = shuffled_bytes(spark, at)
    assert update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240103") == 1
    assert shuffled_bytes(spark, at)[0] < 400_000
    same_as_scan(spark, tmp_dir, "20240103")


def test_values_of_a_version_are_told_apart(spark):
    """Neither a null nor a boundary between two fields may make two versions one."""
    cells = [("a", "b", None), ("ab", "", None), ("a", None, "b"), ("", "ab", None), ("1:a", "b", None), ("a", "b", "-"), (None, None, None), ("-", None, None)]
    rows = spark.createDataFrame([("1", *c, 1) for c in cells], "id string, iso_date string, title string, snippet string, odate_n int")
    rows = rows.select("id", *[F.col(c) if c in rows.columns else F.lit("x").alias(c) for c in VERSION_COLS], "odate_n")
    assert events(rows.unionByName(rows), [1]).count() == len(cells)


def test_a_store_without_digests_is_written_anew(spark, tmp_dir):
    from tessera.sinks.publish import commit

    for d in (1, 2):
        publish(day_rows(spark, [("1", str(d), "t"), ("2", "4", "t")]), f"{tmp_dir}/silver", f"2024010{d}")
    update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", "20240102")
    commit(spark, f"{tmp_dir}/versions", lambda s: s.properties.pop("digests", None))
    same_as_scan(spark, tmp_dir, "20240103")
    assert current(spark, f"{tmp_dir}/versions").properties["digests"]


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    rows = day_rows(spark, [(str(i), "4", "t") for i in range(200)])
    before = shuffle_files(spark)
    publish(rows.repartition(4, "id"), f"{tmp_dir}/silver", "20240101")
    for _ in range(50):  # they are removed behind the write
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert rows.repartition(4, "id").groupBy("rating").count().first()["count"] == 200  # the setting is that of the write alone
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_base_has_a_file_for_each_bucket_and_old_parts_go(spark, tmp_dir):
    from tessera.sinks.files import listing
    from tessera.sinks.publish import KEEP_STATES, LOG

    rows = [(str(i), "4", "t") for i in range(200)]
    for d in range(1, 9):
        publish(day_rows(spark, [(i, str(d), t) if int(i) % 5 == 0 else (i, r, t) for i, r, t in rows]), f"{tmp_dir}/silver", f"2024010{d}")
        update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", f"2024010{d + 1}")
        bases = {k: x for k, x in current(spark, f"{tmp_dir}/versions").partitions.items() if k.startswith("base-")}
        assert all(x.files == x.buckets for x in bases.values())
        assert len([n for n in listing(spark, f"{tmp_dir}/versions/{LOG}") if n.endswith(".json")]) <= KEEP_STATES
    assert "base-20240101" not in bases
    same_as_scan(spark, tmp_dir, "20240109")


def test_rows_that_stand_are_those_of_the_last_event(spark, tmp_dir, monkeypatch):
    """An id with events in the base and in a delta stands once."""
    monkeypatch.setattr(V, "RATIO", 1e9)
    rows = [(str(i), "4", "t") for i in range(200)]
    for d in (1, 2):
        publish(day_rows(spark, [(i, str(d), t) if int(i) % 10 == 0 else (i, r, t) for i, r, t in rows]), f"{tmp_dir}/silver", f"2024010{d}")
        update(spark, f"{tmp_dir}/versions", f"{tmp_dir}/silver", f"2024010{d + 1}")
    assert len(current(spark, f"{tmp_dir}/versions").partitions) == 2
    assert V.standing(stored_events(spark, f"{tmp_dir}/versions"), 20240102).count() == 200
