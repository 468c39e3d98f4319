import duckdb
import pytest

from pyspark.sql import functions as F

from tessera.llm import oracle
from tessera.llm.mixing import mix, mixed, source_targets
from tests.llm.helpers import SF001, SF01, no_documents, odd_documents, odd_rows


def plain_targets(sizes, cap=3):
    """Shares by weight; what is above a cap is shared again until none is."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, free, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in list(free):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] > cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {"a": 0, None: 7, "b": 3}, {"z": 1}, {"a": 0}, {f"s{i}": (i * 37) % 91 for i in range(40)}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, (1, 2, 3), 3).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_equals_oracle(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    got = mix(docs).select("id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(oracle.MIXING).fetchall())


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = mix(docs).collect()
    assert all(r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] for r in rows)
    taken, target = {}, {}
    for r in rows:
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.taken, r.target
    assert all(abs(taken[s] - target[s]) <= 0.04 * target[s] for s in taken)
    assert sorted(rows) == sorted(mix(docs.repartition(13)).collect())
    copies = mixed(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r.doc_id: r.n for r in copies} == {r.id: r.copies for r in rows if r.copies}


def test_weights_favour_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = mix(docs, weight=(F.col("doc_id") % 2).cast("double")).collect()
    assert not any(r.copies for r in rows if r.id % 2 == 0) and any(r.copies for r in rows if r.id % 2)


def test_odd_documents(spark):
    rows = mix(odd_documents(spark)).collect()
    assert sorted((repr(r.id), r["size"]) for r in rows) == sorted((repr(i), len((t or "").encode().split())) for i, t, *_ in odd_rows())
    assert mixed(odd_documents(spark)).columns == odd_documents(spark).columns
    assert mix(no_documents(spark)).count() == 0 and mixed(no_documents(spark)).count() == 0


def test_graded_weights_give_graded_inclusion(spark):
    """Documents of weight 0.5, 1 and 2 in one source: expected copies in proportion, certain whole copies first."""
    rows = [(i, "one two three four five six seven eight nine ten", "a" if i < 3000 else "b", (0.5, 1.0, 2.0)[i % 3]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    found = {r.id: r for r in mix(df, weight=F.col("w")).collect()}
    assert abs(sum(r.taken for r in found.values() if r.source == "a") - 20_000) <= 10  # a third of all words
    for k, due in enumerate((20_000 * 0.5 / 35_000, 20_000 / 35_000, 40_000 / 35_000)):
        copies = [found[i].copies for i in range(k, 3000, 3)]
        assert set(copies) == ({0, 1} if due < 1 else {1, 2}) and abs(sum(copies) / 1000 - due) < 0.05
