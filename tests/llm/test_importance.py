import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm.importance import BUCKETS, fit_ratio, kth_largest, log_weights, ngram_buckets, resample
from tests.llm.helpers import SF001, SF01, frame, no_documents, odd_documents, odd_rows


def test_weights_against_plain_counting(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = docs.filter("doc_id % 3 = 0")
    grams = {d: ngram_buckets(pa.array([t]))[0].tolist() for d, t in rows}
    assert all(len(g) == max(0, 2 * len(t.split()) - 1) for (_, t), g in zip(rows, grams.values()))
    raw = collections.Counter(x for g in grams.values() for x in g)
    wanted = collections.Counter(x for d, g in grams.items() if d % 3 == 0 for x in g)
    n, m = sum(raw.values()) + BUCKETS, sum(wanted.values()) + BUCKETS
    plain = {d: sum(math.log((wanted[x] + 1) / m) - math.log((raw[x] + 1) / n) for x in g) for d, g in grams.items()}
    got = {r.id: r.log_weight for r in log_weights(docs, fit_ratio(docs, target)).collect()}
    assert got == pytest.approx(plain)


def test_labelled_quality_is_told_apart(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = resample(docs, fit_ratio(docs, labels.filter("quality = 1"))).collect()
    assert sum(r.selected for r in rows) == len(rows) // 2
    quality = dict(frame(SF01, "SELECT doc_id, quality FROM labels").itertuples(index=False))
    good, bad = ([r.log_weight for r in rows if quality.get(r.id) == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_gumbel_top_k_follows_the_weights(spark):
    """Two kinds of text whose weights differ by ln 3: the heavier is drawn first three times as often."""
    docs = spark.createDataFrame([(i, "heavy" if i % 2 else "light") for i in range(8000)], "doc_id long, text string")
    ratio = np.zeros(BUCKETS)
    ratio[ngram_buckets(pa.array(["heavy"]))[0][0]] = math.log(3)
    rows = resample(docs, ratio, fraction=0.1).collect()
    heavy = sum(r.id % 2 for r in rows if r.selected)
    assert sum(r.selected for r in rows) == 800 and 0.70 <= heavy / 800 <= 0.79


def test_kth_largest(spark):
    values = [5, -3, 5, 1 << 62, -(1 << 63), 0, 70_000, -70_000, 5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [kth_largest(df, "v", k) for k in range(1, 10)] == sorted(values, reverse=True)


def test_odd_documents(spark):
    odd = odd_documents(spark)
    rows = resample(odd, fit_ratio(odd, odd.filter("doc_id = 7")), fraction=0.5).collect()
    assert len(rows) == len(odd_rows()) and sum(r.selected for r in rows) == len(rows) // 2
    assert all(r.log_weight == 0 for r in rows if r.id in (1, 2, 3))
    assert (fit_ratio(odd, no_documents(spark)) == 0).all()
    assert resample(no_documents(spark), np.zeros(BUCKETS)).count() == 0
