"""Near-duplicate embeddings by random-hyperplane sign hashing.

Each of several tables hashes a vector to the signs of its products with some
random hyperplanes; vectors of equal label and hash in any table are compared
by exact cosine, and those at or above the threshold link.  Two vectors at
angle a agree in one bit with probability 1 - a / pi, so a pair at cosine 0.93
meets in one of 24 tables of 14 bits with probability 0.987.

Equal vectors count as one with a multiplicity.  A bucket larger than a block
is split into blocks, and every pair of blocks is a group of its own, so no
group grows with the data.  A pair that meets in several tables counts in the
first alone, which both vectors' hashes tell, so no pairs are emitted: a group
gives off each vector's number of links and one edge to its local component.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.components import components, local_roots

#: Vectors of a block; a group holds at most two blocks.
BLOCK = 1024


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _codes(classes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """Adds ``codes``, the hash of each table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            out = np.zeros((batch.num_rows, tables), np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng(seed + dim).standard_normal((dim, tables * bits))
                at = np.flatnonzero(dims == dim)
                signs = _matrix(batch.column("vec").take(pa.array(at))) @ planes[dim] > 0
                out[at] = signs.reshape(len(at), tables, bits) @ (1 << np.arange(bits, dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "codes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, codes array<int>")


def group_links(vec: np.ndarray, codes: np.ndarray, n: np.ndarray, table: int, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the vectors of one group: number of links found in this table first, and local component.

    ``side`` is 0 or 1 where only pairs across two blocks count, else all 0.
    """
    m = len(vec)
    norm = np.sqrt((vec * vec).sum(1))
    cross = side.any()
    links, left, right = np.zeros(m, np.int64), [], []
    for a in range(0, m, 256):
        cosine = (vec[a : a + 256] @ vec.T) / (norm[a : a + 256, None] * norm)
        i, j = np.nonzero(cosine >= threshold)
        i += a
        ok = (i < j) & ((side[i] != side[j]) if cross else True)
        i, j = i[ok], j[ok]
        first = ~(codes[i, :table] == codes[j, :table]).any(1)
        i, j = i[first], j[first]
        links += np.bincount(i, n[j], m).astype(np.int64) + np.bincount(j, n[i], m).astype(np.int64)
        left.append(i)
        right.append(j)
    return links, local_roots(m, np.concatenate(left), np.concatenate(right))


def sizes(rows: int, threshold: float, recall: float, bits: int | None = None) -> tuple[int, int]:
    """(bits, tables): a bit more for twice the rows of the largest label, 14 at least, and tables enough for the recall.

    Two vectors at cosine c agree on a random plane's side with a chance of
    1 - acos(c) / pi, so on all bits of a table with that to the power of bits.
    """
    bits = bits or min(31, max(14, math.ceil(math.log2(max(1, rows) / 4))))
    agree = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log1p(-agree))) if 0 < agree < 1 else 1


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", *,
                           threshold: float = 0.93, tables: int | None = None, bits: int | None = None, recall: float = 0.9875, seed: int = 7) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of ``df``.

    Rows link if their labels are equal and not null, their vectors have equal
    length and the cosine, in double precision, is at least ``threshold``.
    ``n_links`` counts the rows linked directly; equal vectors link.
    ``component_id`` is the smallest id reachable, itself included.

    Without ``bits`` and ``tables`` they follow the number of rows (``sizes``):
    buckets of unlike vectors stay small however many rows there are, and a pair at
    the threshold meets in some table with a chance of ``recall``.

    Vectors that are null, empty or zero, or hold null, NaN or infinite
    components, link with nothing.  A null id is a component's id only if the
    component has no other.  Repeated rows are rows of their own and link.
    An empty table gives no rows.  Other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).cast("string").alias("label"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    usable = rows.filter(F.col("label").isNotNull() & fine)
    if bits is None or tables is None:
        most = usable.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
        bits, tables = sizes(most, threshold, recall, bits)
    classes = usable.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n")).select(
        F.monotonically_increasing_id().alias("c"), "label", F.size("vec").alias("dim"), "vec", "least", "n")
    classes = materialise(_codes(classes, tables, bits, seed), "vectors-classes")
    key = ["label", "dim", "t", "code"]
    dealt = classes.select("label", "dim", F.posexplode("codes").alias("t", "code"), "c", "vec", "codes", "n")
    groups = dealt.groupBy(*key).agg(F.count("*").alias("m")).filter("m > 1").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).drop("m")
    groups = materialise(groups, "vectors-groups")
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    # Every block meets every block, itself included; between two blocks only pairs across them count.
    split = dealt.join(groups, key).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"b1": F.least("own", "other"), "b2": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    group_key = [*key, "b1", "b2"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: pa.Table) -> pa.RecordBatch | None:
            if group.num_rows < 2:
                return None
            codes = group.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
            links, root = group_links(_matrix(group.column("vec").combine_chunks()), codes, group.column("n").to_numpy(), group.column("t")[0].as_py(),
                                      group.column("side").to_numpy(), threshold)
            at, c = np.flatnonzero(links), group.column("c").to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(c[at]), pa.array(links[at]), pa.array(c[root[at]])], names=["c", "links", "root"]) if len(at) else None

        held: list[pa.RecordBatch] = []  # the rows of the group that may go on
        last, out = None, []
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in group_key]))
            start = 0
            for i in range(len(keys)):
                if keys[i] != last:
                    if held or i > start:
                        done = found(pa.Table.from_batches([*held, batch.slice(start, i - start)]))
                        out += [done] if done is not None else []
                    held, start, last = [], i, keys[i]
            held.append(batch.slice(start))
            if len(out) > 100:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if held and (done := found(pa.Table.from_batches(held))) is not None:
            out.append(done)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    links = split.select(*group_key, "side", "c", "vec", "codes", "n").repartition(*group_key).sortWithinPartitions(*group_key).mapInArrow(
        run, "c long, links long, root long")
    links = materialise(links, "vectors-links")
    roots = components(links.select(F.col("c").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("c").agg(F.sum("links").alias("links"))
    named = classes.select("c", "label", "vec", "least", "n").join(counted, "c", "left").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "root", F.coalesce("root", "c"))
    named = materialise(named.select("label", "vec", "least", "root", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vectors-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialise(named.join(least, "root").select("label", "vec", "n_links", "component_id", F.lit(True).alias("known")), "vectors-known")
    out = rows.join(known, ["label", "vec"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
