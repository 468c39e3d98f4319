"""Hard negatives by branch and bound over vertical columns (BOND).

Rows are packed into shards that hold one column for each dimension, with its
least and greatest component.  An anchor reads the columns in the order of its
own descending magnitudes; after every few of them each row's partial product
and the least and greatest that the columns still unread can add bound its
final product, and rows that can no longer enter the answer leave the
candidate bitmap.  What is left at the end has exact products.

Two scans: the first finds an anchor's positives (its nearest rows of the same
label), whose products open the windows in which the second one looks for
rows of other labels.  Anchors go in blocks; a pair of a shard and a block is
one group of a shuffle, and the few best of every shard merge exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import materialise

#: Bytes of components in a shard, anchors in a block, columns read between two prunings.
SHARD_BYTES, BLOCK, STEP = 4 << 20, 4096, 8
#: Components beyond this, after scaling, count as this, so that a product of up to 2^10 of them fits a long.
LIMIT = 1 << 26

_SHARDS = "dim int, shard long, n int, ids binary, known binary, labels binary, components binary"


def _pack(scale: int):
    """Rows (vec_id, label, vector) to shards of rows of one length."""
    def flush(dim: int, shard: int, held: list) -> pa.RecordBatch:
        ids, known, labels, rows = (np.concatenate(x) for x in zip(*held))
        columns = [pa.array([v], t) for v, t in (
            (dim, pa.int32()), (shard, pa.int64()), (len(ids), pa.int32()), (ids.tobytes(), pa.binary()), (known.tobytes(), pa.binary()),
            (labels.tobytes(), pa.binary()), (np.ascontiguousarray(rows.T).tobytes(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["dim", "shard", "n", "ids", "known", "labels", "components"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            vectors, flat = batch.column("vector"), batch.column("vector").flatten()
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes nan
            owner = np.repeat(np.arange(len(lengths)), lengths)
            bad = np.bincount(owner[~np.isfinite(values)], minlength=len(lengths)) > 0
            ok = ~bad & vectors.is_valid().to_numpy(zero_copy_only=False) & batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            with np.errstate(all="ignore"):
                whole = np.clip(np.floor(values * scale), -LIMIT, LIMIT)
            whole = np.where(np.isfinite(values), whole, 0).astype(np.int32)
            known = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False)
            labels = batch.column("label").fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[ok]).tolist():
                at = np.flatnonzero(ok & (lengths == dim))
                most = max(1, SHARD_BYTES // max(4, 4 * dim))
                for a in range(0, len(at), most):
                    part = at[a:a + most]
                    rows = whole[starts[part][:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((ids[part], known[part], labels[part], rows))
                    if sum(len(x[0]) for x in held[dim]) >= most:
                        yield flush(dim, made, held.pop(dim))
                        made += 1
        for dim, left in held.items():
            yield flush(dim, made, left)
            made += 1

    return work


def shards_of(df: DataFrame, id_col: Column, label_col: Column, vector_col: Column, scale: int) -> DataFrame:
    """Written shards of the rows that take part."""
    rows = df.select(id_col.cast("long").alias("vec_id"), label_col.cast("long").alias("label"), vector_col.cast("array<double>").alias("vector"))
    return materialise(rows.mapInArrow(_pack(scale), _SHARDS), "negatives-shards")


class Shard:
    """A shard's columns with their extremes."""

    def __init__(self, row: dict) -> None:
        n, dim = row["n"], row["dim"]
        self.key, self.n = row["shard"], n
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.columns = np.frombuffer(row["components"], np.int32).reshape(dim, n)
        self.least = self.columns.min(axis=1).astype(np.int64) if dim else np.zeros(0, np.int64)
        self.most = self.columns.max(axis=1).astype(np.int64) if dim else np.zeros(0, np.int64)

    def first(self, rows: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` rows: greatest product, then smallest id, null ids last."""
        if len(rows) > k:  # ties of the k-th stay for the ids to decide
            near = products >= np.partition(products, -k)[-k]
            rows, products = rows[near], products[near]
        order = np.lexsort((self.ids[rows], ~self.known[rows], -products))[:k]
        return rows[order], products[order]


def bond(shard: Shard, anchor: np.ndarray, rows: np.ndarray, windows: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``rows`` that can be among the first ``k`` of a window of products, and their exact products.

    ``windows`` are inclusive (least, greatest) products.
    """
    anchor = anchor.astype(np.int64)
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    ends = np.stack([anchor[order] * shard.least[order], anchor[order] * shard.most[order]])
    after = np.concatenate([np.cumsum(np.stack([ends.min(0), ends.max(0)])[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), np.int64)], axis=1)
    part = np.zeros(len(rows), np.int64)
    for a in range(0, len(order), STEP):
        step = order[a:a + STEP]
        for d in step:
            part += anchor[d] * shard.columns[d, rows]
        below, above = part + after[0, a + len(step)], part + after[1, a + len(step)]
        alive = np.zeros(len(rows), bool)
        for low, high in windows:
            inside = (above >= low) & (below <= high)
            sure = below[inside & (below >= low) & (above <= high)]
            if len(sure) >= k:  # k rows surely within: whatever stays below the k-th of them is out
                inside &= above >= np.partition(sure, -k)[-k]
            alive |= inside
        if not alive.all():
            rows, part = rows[alive], part[alive]
        if not len(rows):
            break
    return rows, part


_EVERY = (-(1 << 62), 1 << 62)
_POSITIVES = "a_shard long, a_row int, anchor_id long, positive_id long, positive_score long"
_NEGATIVES = "a_shard long, a_row int, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def _ids(shard: Shard, rows: np.ndarray) -> list:
    return [i if known else None for i, known in zip(shard.ids[rows].tolist(), shard.known[rows].tolist())]


def _positives(k: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            shard = Shard(left.slice(0, 1).to_pylist()[0])
            for a in right.column("anchors")[0].as_py():
                rows = shard.labels == a["label"]
                if a["shard"] == shard.key:
                    rows[a["row"]] = False
                found = shard.first(*bond(shard, np.frombuffer(a["vector"], np.int32), np.flatnonzero(rows), [_EVERY], k), k)
                out += [(a["shard"], a["row"], a["id"], i, s) for i, s in zip(_ids(shard, found[0]), found[1].tolist())]
        return _table(out, ["a_shard", "a_row", "anchor_id", "positive_id", "positive_score"], {1})

    return work


def _negatives(k: int, low: int, high: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            shard = Shard(left.slice(0, 1).to_pylist()[0])
            for a in right.column("anchors")[0].as_py():
                windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in a["positives"] or []]
                open_ = sorted({w for w in windows if w[0] <= w[1]})
                if not open_:
                    continue
                rows, products = bond(shard, np.frombuffer(a["vector"], np.int32), np.flatnonzero(shard.labels != a["label"]), open_, k)
                for p, (least, greatest) in zip(a["positives"], windows):
                    within = (products >= least) & (products <= greatest)
                    found = shard.first(rows[within], products[within], k)
                    out += [(a["shard"], a["row"], a["id"], p["place"], p["id"], p["score"], i, s) for i, s in zip(_ids(shard, found[0]), found[1].tolist())]
        return _table(out, ["a_shard", "a_row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"], {1, 3})

    return work


def _table(rows: list[tuple], names: list[str], small: set[int]) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int32() if i in small else pa.int64()) for i, c in enumerate(columns)], names=names)


def _anchors(every: int):
    """The rows of a shard whose id is a multiple of ``every``."""
    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0])
                rows = np.flatnonzero(shard.known & (shard.ids % every == 0))
                vectors = [np.ascontiguousarray(shard.columns[:, r]).tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(shard.columns)] * len(rows), pa.int32()), pa.array([shard.key] * len(rows), pa.int64()), pa.array(rows, pa.int32()),
                    pa.array(shard.ids[rows]), pa.array(shard.labels[rows]), pa.array(vectors, pa.binary())], ["dim", "shard", "row", "id", "label", "vector"])

    return work


def _pairs(shards: DataFrame, anchors: DataFrame, keys: DataFrame, blocks: int, extra: list[str]):
    """Every shard beside every block of anchors of its dimension."""
    packed = anchors.withColumn("block", F.pmod(F.xxhash64("shard", "row"), F.lit(blocks)).cast("int")).groupBy("dim", "block").agg(
        F.collect_list(F.struct("shard", "row", "id", "label", "vector", *extra)).alias("anchors"))
    right = packed.join(keys, "dim").select("shard", "block", "anchors")
    left = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", *, every: int = 100, scale: int = 256,
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    A component x becomes floor(scale * x); a score is the integer inner
    product with the anchor.  Anchors are the rows whose id is a multiple of
    ``every``; an anchor's positives are its first ``positives`` other rows of
    its label, higher scores first, ties by smaller id.  For each of them the
    first ``negatives`` rows of another label whose score is ``low`` to
    ``high`` per cent of the positive's.

    Rows with a null label, a null vector or a null or non-finite component
    take no part.  Rows of a null id can be positives and negatives (after
    equal scores with an id) but not anchors.  Of rows that stand several times each
    counts, as an anchor too.  Vectors of another length than the anchor's,
    which have no product with it, are left out.  Components beyond 2^26 after
    scaling count as 2^26.  An empty table gives no rows.  Other columns,
    whatever their names, are not looked at.
    """
    label = F.col(label) if isinstance(label, str) else label
    shards = shards_of(df, F.col(id_col), label, F.col(vector_col), scale)
    keys = materialise(shards.select("dim", "shard"), "negatives-keys")  # a row a shard; the planner checks its size before it broadcasts it
    anchors = materialise(shards.mapInArrow(_anchors(every), "dim int, shard long, row int, id long, label long, vector binary"), "negatives-anchors")
    blocks = max(1, -(-anchors.count() // BLOCK))
    one = ["a_shard", "a_row"]

    def best(rows: DataFrame, by: list[str], score: str, id_: str, k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(id_).asc_nulls_last())
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    near = _pairs(shards, anchors, keys, blocks, []).applyInArrow(_positives(positives), _POSITIVES)
    near = best(near, one, "positive_score", "positive_id", positives)
    held = near.groupBy(*one).agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    opened = materialise(anchors.join(held, F.expr("shard = a_shard AND row = a_row")).drop(*one), "negatives-windows")
    found = _pairs(shards, opened, keys, blocks, ["positives"]).applyInArrow(_negatives(negatives, low, high), _NEGATIVES)
    found = best(found, [*one, "place"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
