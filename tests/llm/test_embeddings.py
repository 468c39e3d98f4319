import numpy as np
import pytest

from tessera.llm import embeddings as E
from tessera.llm.embeddings import near_duplicate_vectors
from tests.llm.helpers import SF001, frame


def plain(rows, threshold):
    """n_links and component of every row by comparing all pairs."""
    n = len(rows)
    ok = [l is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def clusters(seed=4, groups=12, dim=32):
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 15))):
            rows.append((len(rows), (base + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2, 0.35])).astype(np.float32).tolist(), int(g % 3)))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [1024, 4])
def test_recall_and_precision_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = clusters()
    found = sorted(map(tuple, near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()))
    wanted = plain(rows, 0.93)
    links, all_links = sum(r[1] for r in found), sum(r[1] for r in wanted)
    assert all_links > 100 and 0.97 * all_links <= links <= all_links
    assert sum(a == b for a, b in zip(found, sorted(wanted))) >= 0.95 * len(rows)


def test_odd_vectors(spark):
    nan, inf, v = float("nan"), float("inf"), [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [nan, 1.0, 1.0], 1), (6, [inf, 1.0, 1.0], 1), (7, v, None), (8, v, None),
            (9, v, 1), (10, v, 1), (10, v, 1), (None, v, 1), (11, v, 2), (12, [1.0, 2.0], 1), (13, [2.0, 4.0], 1), (None, [9.0, 0.0, 0.0], 1), (14, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "1 AS n", "2 AS c", "3 AS root")
    found = sorted(map(tuple, near_duplicate_vectors(df).collect()), key=repr)
    wanted = [(None, 0, None, True) if r == (None, 0, None, True) or (r[0] is None and r[2] is None) else r for r in plain(rows, 0.93)]
    assert found == sorted(wanted, key=repr)
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_embeddings(spark):
    rows = list(frame(SF001, "SELECT vec_id, embedding, label FROM embeddings").itertuples(index=False, name=None))
    rows = [(int(i), [float(x) for x in v], int(l)) for i, v, l in rows]
    found = near_duplicate_vectors(spark.read.parquet(f"{SF001}/embeddings.parquet"), threshold=0.3).collect()
    wanted = plain(rows, 0.3)
    assert len(found) == len(wanted) and sum(r.n_links for r in found) <= sum(r[1] for r in wanted)


def test_bits_and_tables_follow_the_rows():
    from tessera.llm.embeddings import sizes

    assert sizes(1, 0.93, 0.9875) == sizes(60_000, 0.93, 0.9875) == (14, 24)
    for rows in (10**6, 10**8, 10**9):
        bits, tables = sizes(rows, 0.93, 0.9875)
        agree = (1 - np.arccos(0.93) / np.pi) ** bits
        assert rows / 2**bits <= 4 and 1 - (1 - agree) ** tables >= 0.9875 and tables < 300
    assert sizes(10, 1.0, 0.99)[1] == 1


def test_recall_with_many_bits(spark):
    """The parameters that a hundred million rows would have, on a small table."""
    from tessera.llm.embeddings import sizes

    bits, tables = sizes(10**8, 0.93, 0.9875)
    rows = clusters(seed=6)
    found = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), bits=bits, tables=tables).collect()
    links, all_links = sum(r.n_links for r in found), sum(r[1] for r in plain(rows, 0.93))
    assert 0.95 * all_links <= links <= all_links
