"""Published partitions: a reader sees a table as some commit left it, never half of a write."""

import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.sinks import publish as P
from tessera.sinks.files import create_text, listing, read_text, remove
from tessera.sinks.publish import commit, current, publish, read_table, vacuum, write_aside

ID = StructType([StructField("id", StringType())])


def ids(spark, *values):
    return spark.createDataFrame([(str(v),) for v in values], "id string")


def rows(spark, path, **kw):
    return sorted((r.odate, r.id) for r in read_table(spark, path, ID, **kw).collect())


def test_partitions_are_replaced_one_at_a_time(spark, tmp_dir):
    assert read_table(spark, tmp_dir, ID) is None
    assert publish(ids(spark, 1, 2), tmp_dir, "20240101") == 2
    assert publish(ids(spark, 3).withColumn("odate", F.lit("other")), tmp_dir, "20240102") == 1
    assert publish(ids(spark, 9), tmp_dir, "20240101") == 1
    assert rows(spark, tmp_dir) == [("20240101", "9"), ("20240102", "3")]
    assert rows(spark, tmp_dir, before="20240102") == [("20240101", "9")] and rows(spark, tmp_dir, before="2024") == []
    assert publish(ids(spark), tmp_dir, "20240101") == 0
    assert rows(spark, tmp_dir) == [("20240102", "3")]


def test_a_failed_write_and_a_torn_record_change_nothing(spark, tmp_dir):
    publish(ids(spark, *range(40)), tmp_dir, "20240101")
    before = rows(spark, tmp_dir)
    broken = ids(spark, *range(100, 140)).repartition(4, "id").withColumn("id", F.when(F.col("id") == "139", F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception):
        publish(broken, tmp_dir, "20240101")
    assert rows(spark, tmp_dir) == before and current(spark, tmp_dir).number == 1
    whole = read_text(spark, f"{tmp_dir}/_log/000000000001.json")
    for n, torn in enumerate((whole[: len(whole) // 2], "", whole.replace('"rows": 40', '"rows": 41')), 2):
        assert create_text(spark, f"{tmp_dir}/_log/{n:012d}.json", torn)
    assert rows(spark, tmp_dir) == before
    assert publish(ids(spark, 7), tmp_dir, "20240102") == 1
    assert current(spark, tmp_dir).number == 5 and rows(spark, tmp_dir) == sorted([*before, ("20240102", "7")])


def test_a_write_between_files_and_record_is_not_seen(spark, tmp_dir):
    publish(ids(spark, 1), tmp_dir, "20240101")
    write_aside(ids(spark, 2), tmp_dir, "20240101")  # the writer dies here
    assert rows(spark, tmp_dir) == [("20240101", "1")]


def test_a_reader_keeps_what_it_saw(spark, tmp_dir):
    publish(ids(spark, 1), tmp_dir, "20240101")
    old = read_table(spark, tmp_dir, ID)
    publish(ids(spark, 2), tmp_dir, "20240101")
    assert [r.id for r in old.collect()] == ["1"] and rows(spark, tmp_dir) == [("20240101", "2")]


def test_writers_at_the_same_time_lose_nothing(spark, tmp_dir):
    days = [f"202401{d:02d}" for d in range(1, 9)]
    errors = []

    def write(day):
        try:
            publish(ids(spark, day), tmp_dir, day)
        except Exception as err:  # pragma: no cover
            errors.append(err)

    threads = [threading.Thread(target=write, args=(d,)) for d in days]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and rows(spark, tmp_dir) == [(d, d) for d in days]


def test_plain_partitions_belong_to_the_table_until_they_are_replaced(spark, tmp_dir):
    for day in ("20240101", "20240102"):
        ids(spark, f"plain {day}").write.parquet(f"{tmp_dir}/odate={day}")
    assert [x[0] for x in rows(spark, tmp_dir)] == ["20240101", "20240102"]
    publish(ids(spark, "new"), tmp_dir, "20240102")
    assert rows(spark, tmp_dir) == [("20240101", "plain 20240101"), ("20240102", "new")]
    assert rows(spark, tmp_dir, before="20240102") == [("20240101", "plain 20240101")]


def test_vacuum_keeps_readable_states_and_writes_under_way(spark, tmp_dir):
    for n in range(P.KEEP_STATES + 3):
        publish(ids(spark, n), tmp_dir, "20240101")
    under_way = write_aside(ids(spark, "later"), tmp_dir, "20240101")
    folder = f"{tmp_dir}/_data/odate=20240101"
    vacuum(spark, tmp_dir)
    assert len(listing(spark, f"{tmp_dir}/_log")) == P.KEEP_STATES and len(os.listdir(folder)) == P.KEEP_STATES + 1
    commit(spark, tmp_dir, lambda s: s.partitions.update({"20240101": under_way}))
    assert rows(spark, tmp_dir) == [("20240101", "later")]
    vacuum(spark, tmp_dir, abandoned_s=-60)
    assert rows(spark, tmp_dir) == [("20240101", "later")]
    remove(spark, f"{tmp_dir}/_log")
    assert read_table(spark, tmp_dir, ID) is None


def test_guards(spark, tmp_dir):
    for bad, error in (("not a frame", TypeError), (None, TypeError)):
        with pytest.raises(error):
            publish(bad, tmp_dir, "20240101")
    for path, value in (("", "20240101"), (tmp_dir, "a/b"), (tmp_dir, "")):
        with pytest.raises(ValueError):
            publish(ids(spark, 1), path, value)
