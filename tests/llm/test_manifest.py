import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import manifest as M
from tessera.llm import queries
from tessera.llm.manifest import bitmaps, coordinates, field_digest, fold, manifest
from tests.llm.helpers import SCHEMA, SF001, frame, no_documents, odd_documents, odd_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest_of(*fields):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(nodes):
    """The levels from the nodes to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((("<" if i & 1 else ">") + level[i ^ 1]) if i ^ 1 < len(level) else "")
        i >>= 1
    return out


def plain(rows):
    """(group, id, pos, n, leaf, path, subroot, root) of every (group, id, leaf)."""
    groups = {}
    for g, i, leaf in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for pos, (known, i, leaf) in enumerate(sorted(groups[g])):
            out.append((g, i if known else None, pos, len(groups[g]), leaf, path_of(trees[g], pos) + path_of(top, place), trees[g][-1][0], top[-1][0]))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(list(v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr)


def leaves(spark, rows):
    return spark.createDataFrame([(i, g, leaf) for g, i, leaf in rows], "doc_id long, lang string, leaf string")


@pytest.mark.parametrize("levels", [10, 2])
def test_equals_the_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    rows = [(f"g{n}", 3 * i, sha(f"{n} {i}")) for n in (1, 2, 3, 5, 8, 33) for i in range(n)]
    assert result(manifest(leaves(spark, rows), F.col("leaf"))) == plain(rows)


def test_ids_far_apart_repeated_and_null(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN", 2)
    wide = [0, 1, 63, 64, 65, 4095, 4096, 2**16, 2**28 + 1, 2**44 + 5, 2**62, 2**63 - 1, -1, -64, -4097, -2**63]
    rows = [("a", i, sha(f"a{i}")) for i in wide]
    rows += [("a", 64, sha(f"copy {k % 3}")) for k in range(11)] + [("a", None, sha(f"none {k % 4}")) for k in range(9)]
    rows += [(None, None, sha("x")), (None, 5, sha("y")), ("", 5, sha("y")), ("é", 5, sha("z")), ("z", -3, sha("w"))]
    assert result(manifest(leaves(spark, rows), F.col("leaf"))) == plain(rows)


def test_containers_hold_every_id_once(spark):
    ids = spark.createDataFrame([("a", i) for i in (5, 5, 70, 4095, 4096, -1)], "grp string, id long")
    found = {r["high"]: (r["summary"], list(r["words"]), r["before"], [tuple(m) for m in r["more"] or []]) for r in bitmaps(ids)[0].collect()}
    assert found[0][0] == (1 | 2 | 1 << 63) - (1 << 64) and found[0][1] == [1 << 5, 1 << 6, -(1 << 63)] and found[0][2:] == (1, [(5, 1)])
    assert found[1][2] == 5 and found[-1][2] == 0


def test_coordinates_do_not_sort_the_leaves(spark):
    rows = spark.createDataFrame([("a", i, sha(str(i))) for i in range(50)], "grp string, id long, leaf string")
    assert sorted(r["pos"] for r in coordinates(rows).collect()) == list(range(50))


def test_tampering_shows_and_empty_tables(spark):
    rows = [("a", i, sha(str(i))) for i in range(7)]
    found = manifest(leaves(spark, rows), F.col("leaf"), carry={"tried": F.when(F.col("doc_id") == 4, F.lit(sha("other")))})
    kept = {r["id"]: r["ok"] for r in found.select("id", (fold(F.coalesce("tried", "leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()}
    assert kept == {i: i != 4 for i in range(7)}
    assert manifest(no_documents(spark), field_digest(F.col("doc_id"))).count() == 0


def test_odd_documents(spark):
    rows = [(lang, i, digest_of(i, source, lang, n, text)) for i, text, lang, source, n in odd_rows()]
    leaf = field_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    assert result(manifest(odd_documents(spark).withColumns({c: F.lit("x") for c in ("grp", "pos", "path", "block", "nodes")}), leaf)) == plain(rows)
    assert [f.dataType.simpleString() for f in spark.createDataFrame([], SCHEMA).schema][:2] == ["bigint", "string"]


def test_registered_query(spark):
    docs = [tuple(None if v != v else v for v in r) for r in frame(SF001, "SELECT doc_id, source, lang, n_chars, text FROM documents").itertuples(index=False, name=None)]
    wanted = {r[1]: r for r in plain([(d[2], d[0], digest_of(*d)) for d in docs])}
    found = {r["doc_id"]: r for r in queries.op11_manifest(spark, SF001).collect()}
    assert found.keys() == wanted.keys()
    for d in docs:
        _, _, _, _, leaf, path, subroot, root = wanted[d[0]]
        tampered = zlib.crc32(str(d[0]).encode()) % 7 == 0
        node = digest_of(*d[:3], d[3] + 1, d[4]) if tampered and d[3] is not None else leaf
        for s in path:
            node = sha(s[1:] + node if s[:1] == "<" else node + s[1:])
        r = found[d[0]]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) == (leaf, subroot, root, sha("".join(s[1:] for s in path)), node, node == root)
    assert not all(r["verified"] for r in found.values())
