import collections

import numpy as np
import pytest

from tessera.llm import repeats
from tessera.llm.repeats import leftmost_min, remove_repeats, run_hashes
from tests.llm.helpers import SF001, no_documents, odd_documents, odd_rows


def plain(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (id_, _), w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append((id_, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(map(tuple, remove_repeats(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("contexts", [20_000, 1])
def test_documents_against_all_windows(spark, monkeypatch, contexts):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", contexts)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got(docs) == plain([(r.doc_id, r.text) for r in docs.collect()], 35)


@pytest.mark.parametrize("window,prefix", [(35, 16), (5, 2), (3, 3)])
def test_few_words_with_many_ties(spark, window, prefix):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "c"], int(n)))) for i, n in enumerate(rng.integers(0, 120, 30))]
    rows += [(100, "a " * 90), (101, "a b " * 50), (102, rows[3][1]), (103, rows[4][1] + " z " + rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, window=window, prefix=prefix) == plain(rows, window)


def test_odd_documents(spark):
    assert got(odd_documents(spark)) == plain([r[:2] for r in odd_rows()], 35)
    assert remove_repeats(no_documents(spark)).count() == 0


def test_helpers():
    h = np.random.default_rng(0).integers(0, 5, 200).astype(np.uint64)
    for n in (1, 2, 7, 16, 35):
        runs = run_hashes(h, n)
        assert len(runs) == 200 - n + 1
        assert len({tuple(h[i : i + n]) for i in range(len(runs))}) == len(set(runs.tolist()))
    at = leftmost_min(h, 20)
    assert at.tolist() == [i + int(np.argmin(h[i : i + 20])) for i in range(181)]


def test_one_passage_in_many_documents(spark, monkeypatch):
    """Different surroundings everywhere: the passage's windows are counted, and no task of the tree stage gets their group."""
    seen = spark.sparkContext.accumulator(0)
    original = repeats.deep_leaves

    def counted(suffixes, depth):
        seen.add(len(suffixes))
        return original(suffixes, depth)

    monkeypatch.setattr(repeats, "deep_leaves", counted)
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", 40)
    passage = [f"p{i}" for i in range(45)]
    rows = [(d, " ".join([f"a{d}x{i}" for i in range(40 + d % 7)] + passage + [f"b{d}x{i}" for i in range(40)])) for d in range(400)]
    rows += [(1000 + d, " ".join([f"c{d}x{i}" for i in range(50)] + [f"q{i}" for i in range(38)] + [f"e{d}" for _ in range(9)])) for d in range(3)]
    found = {r.id: (r.n_removed, r.kept) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        gone = set(passage) if d < 1000 else {f"q{i}" for i in range(38)}
        kept = [w for w in text.split() if w not in gone]
        assert found[d] == (len(text.split()) - len(kept), " ".join(kept))
    assert 0 < seen.value < 1000
