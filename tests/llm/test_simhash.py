import collections

import numpy as np
import pytest
import xxhash


from tessera.llm.simhash import keep_one, near_duplicates, region_links
from tests.llm.helpers import SF001, SF01, no_documents, odd_documents, odd_rows

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, k=4):
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, distance):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    members = collections.defaultdict(list)
    for i in range(len(fps)):
        members[find(i)].append(ids[i])
    return [min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(fps))]


def compare(found, rows, distance=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    least = plain_components(fps, [i for i, _ in rows], distance)
    assert sorted(map(repr, ((r.id, r.fp % (1 << 64), r.component_id) for r in found))) == sorted(map(repr, ((i, f, c) for (i, _), f, c in zip(rows, fps, least))))


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    compare(near_duplicates(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_documents(spark):
    compare(near_duplicates(odd_documents(spark)).collect(), [r[:2] for r in odd_rows()])
    assert near_duplicates(no_documents(spark)).count() == 0


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(no_documents(spark), distance=3)


@pytest.mark.parametrize("memory", [1 << 22, 5_000])
def test_regions_find_every_connection(memory):
    """All regions together connect what all pairs connect, with and without splitting."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, int(n), replace=False))) for n in rng.integers(0, 6, 160)]
    fps = np.unique(np.concatenate([base, np.repeat(base, 4) ^ np.array(flips, np.uint64)]))
    parent = np.arange(len(fps))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for region in range(16):
        for a, b in region_links(fps, region, 4, 2, memory):
            assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all()
            for x, y in zip(a, b):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    assert [fps[find(i)] for i in range(len(fps))] == plain_components(fps.tolist(), fps.tolist(), 4)


def test_keep_one_leaves_one_row_of_each_component(spark):
    kept = keep_one(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    fps = [plain_fingerprint(t) for _, t in [r[:2] for r in odd_rows()]]
    groups = {plain_components(fps, list(range(len(fps))), 4)[i] for i in range(len(fps))}
    assert len(rows) == len(groups) and {i for i, _ in rows} >= {1, 5, 6, 9, 10}
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    wanted = {r.id for r in near_duplicates(docs).collect() if r.id == r.component_id}
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == sorted(wanted)
    assert keep_one(no_documents(spark)).count() == 0
