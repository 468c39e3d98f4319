import math

import numpy as np
import pytest

from tessera.llm import negatives as N
from tessera.llm import queries
from tessera.llm.negatives import Shard, bond, hard_negatives
from tests.llm.helpers import SF01, frame, rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every, positives=5, negatives=5, scale=256):
    """The result by all products."""
    kept = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-N.LIMIT, min(N.LIMIT, math.floor(x * scale))) for x in v], label))
    place = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for k, (a, v, label) in enumerate(kept):
        if a is None or a % every:
            continue
        others = [(i, sum(x * y for x, y in zip(v, w)), other) for j, (i, w, other) in enumerate(kept) if j != k and len(w) == len(v)]
        for p in sorted((o for o in others if o[2] == label), key=place)[:positives]:
            near = [o for o in others if o[2] != label and 80 * p[1] <= 100 * o[1] <= 100 * p[1]]
            out += [(a, p[0], r, o[0], p[1], o[1]) for r, o in enumerate(sorted(near, key=place)[:negatives], 1)]
    return sorted(out, key=repr)


def random_rows(n=400, dim=12, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(5, dim))
    rows = [(i, (base[i % 5] + rng.normal(size=dim) * 0.3).tolist(), int(rng.integers(labels))) for i in range(n)]
    return rows + [(n + i, rows[i][1], int(rng.integers(labels))) for i in range(60)]  # copies, so that scores tie


@pytest.mark.parametrize("step,shard,block", [(8, 4 << 20, 4096), (1, 700, 3), (3, 48, 1)])
def test_equals_all_products(spark, monkeypatch, step, shard, block):
    for name, value in (("STEP", step), ("SHARD_BYTES", shard * 4), ("BLOCK", block)):
        monkeypatch.setattr(N, name, value)
    rows = random_rows(200 if shard == 48 else 400)
    assert rows_of(hard_negatives(spark.createDataFrame(rows, SCHEMA), every=20)) == plain(rows, 20)


def test_bond_prunes_and_keeps_exact_products():
    rng = np.random.default_rng(3)
    columns = (rng.normal(size=(64, 5000)) * 30 * (0.8 ** np.arange(64))[:, None]).astype(np.int32)
    shard = Shard({"n": 5000, "dim": 64, "shard": 0, "ids": np.arange(5000).tobytes(), "known": np.ones(5000, bool).tobytes(), "labels": np.zeros(5000, np.int64).tobytes(),
                   "components": columns.tobytes()})
    products = columns[:, 7].astype(np.int64) @ columns
    rows, found = bond(shard, columns[:, 7], np.arange(5000), [(-(1 << 62), 1 << 62)], 5)
    assert len(rows) < 500 and (products[rows] == found).all() and set(np.argsort(-products)[:5]) <= set(rows)
    low, high = int(np.sort(products)[-40]), int(np.sort(products)[-30])
    rows, found = bond(shard, columns[:, 7], np.arange(5000), [(low, high)], 5)
    inside = np.flatnonzero((products >= low) & (products <= high))
    assert set(sorted(inside, key=lambda r: -products[r])[:5]) <= set(rows)


def test_odd_rows(spark):
    nan, inf, v = float("nan"), float("inf"), [1.0, 2.0, -3.0]
    rows = [(0, v, 1), (0, v, 1), (0, v, 2), (None, v, 1), (None, v, 2), (1, None, 1), (2, [], 1), (3, [1.0, None, 2.0], 1), (4, [nan, 1.0, 1.0], 1), (5, [inf, 1.0, 1.0], 2),
            (6, v, None), (7, [1.0, 2.0], 2), (8, [0.9, 2.0, -3.0], 2), (100, [0.0, 0.0, 0.0], 1), (200, [], 2), (300, [], 1), (400, [1e300, -1e300, 1.0], 2), (9, [1e300, 0.0, 0.0], 1), (10, [-0.001, 0.0, 0.0], 1),
            (500, [-1.0, -2.0, 3.0], 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "1 AS n", "2 AS shard", "3 AS dim", "4 AS rank", "5 AS block")
    assert rows_of(hard_negatives(df)) == plain(rows, 100)
    assert plain(rows, 100)
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark):
    rows = [(int(i), [float(x) for x in v], (int(label) + 1) % 10 if i % 7 == 0 else int(label)) for i, v, label in frame(SF01, "SELECT vec_id, embedding, label FROM embeddings").itertuples(index=False, name=None)]
    found = rows_of(queries.op12_negatives(spark, SF01))
    assert found == plain(rows, 100) and found
