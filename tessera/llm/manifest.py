"""Merkle manifest of a table whose leaf order comes from bitmap ranks.

The leaves of a group ascend by id.  Their coordinates are not found by
sorting: the ids of a group become compressed bitmaps (containers of 4,096
ids: a summary word says which of 64 words hold a bit, only those are kept,
with the popcounts before each), partial bitmaps are merged by OR, and a
directory adds up the containers before each one.  A leaf's coordinate is then
the container's entry, the popcount before its word and the popcount of its
word below its bit.

Levels are reduced many at a time: ``pos >> 10`` is a node's key and the low
ten bits its slot, so a block of 1,024 slots gives ten levels in one task and
one node to the next round.  The blocks are written, and read again from the
top down to give every leaf its path of siblings.

Every two consecutive nodes become ``sha256(left + right)`` of their
lowercase hex digests; a last single one becomes ``sha256(itself)``.  A path
holds one entry a level: ``>`` and the digest of a sibling to the right, ``<``
and that of one to the left, empty where the node stands alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tessera.llm.common import materialise

#: Bits of an id within a word, and within a container.
WORD, CONTAINER = 6, 12
#: Bits by which the levels of the container directory differ: a window adds up at most 65,536 rows.
RADIX = 16
#: Levels that a block of slots reduces at once.
LEVELS = 10
#: Equal rows that one task gives coordinates in a row.
RUN = 4096


def field_digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields in turn: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives along ``path``; it equals the tree's root only for the leaf that stands there."""
    def step(node: Column, sibling: Column) -> Column:
        digest = F.substring(sibling, 2, 64)
        return F.sha2(F.when(F.startswith(sibling, F.lit("<")), F.concat(digest, node)).otherwise(F.concat(node, digest)), 256)

    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """The digests of a path, joined from the leaf up."""
    return F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "")


def _low(bits: Column | str) -> str:
    return f"~shiftleft(-1L, cast({bits} AS int))"


def bitmaps(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Containers of the ids of (grp, id) rows, and (grp, n, n_null) totals, null ids included.

    A container has ``summary``, ``words``, ``ranks`` (distinct ids before each
    word), ``more`` (ids that stand more than once, with their further copies)
    and ``before`` (rows of lower containers of its group).
    """
    counted = ids.groupBy("grp", "id").agg(F.count("*").alias("n"))
    totals = counted.groupBy("grp").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    known = counted.filter("id IS NOT NULL").withColumn("high", F.expr(f"shiftright(id, {CONTAINER})"))
    words = known.groupBy("grp", "high", F.expr(f"shiftright(id, {WORD}) & 63").cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(id & 63 AS int)))").alias("bits"), F.sum("n").alias("n"))
    merged = words.groupBy("grp", "high").agg(
        F.expr("bit_or(shiftleft(1L, word))").alias("summary"), F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("kept"), F.sum("n").alias("n"))
    ranks = F.aggregate("kept", F.array(F.lit(0)), lambda acc, w: F.concat(acc, F.array(F.element_at(acc, -1) + F.bit_count(w["bits"]))))
    more = known.filter("n > 1").groupBy("grp", "high").agg(
        F.collect_list(F.struct(F.expr(f"id & {(1 << CONTAINER) - 1}").alias("low"), (F.col("n") - 1).alias("n"))).alias("more"))
    held = merged.select("grp", "high", "summary", F.transform("kept", lambda w: w["bits"]).alias("words"), ranks.alias("ranks"), "n")
    held = materialise(held.join(more.select(F.col("grp").alias("g"), F.col("high").alias("h"), "more"), F.expr("grp <=> g AND high = h"), "left").drop("g", "h"), "manifest-bitmaps")
    return _directory(held), totals


def _directory(containers: DataFrame) -> DataFrame:
    """``before``: the rows of lower containers, by sums of sums, so that no window holds more than 65,536 rows."""
    steps = range(RADIX, 64 - CONTAINER, RADIX)
    at = containers.select("grp", "high", "n")
    above = None
    for shift in reversed([0, *steps]):
        level = at.groupBy("grp", F.expr(f"shiftright(high, {shift})").alias("key")).agg(F.sum("n").alias("n"))
        level = level.withColumn("up", F.lit(0) if above is None else F.expr(f"shiftright(key, {RADIX})"))
        within = F.coalesce(F.sum("n").over(Window.partitionBy("grp", "up").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        level = level.withColumn("before", within)
        if above is not None:
            level = level.join(above, F.expr("grp <=> a_grp AND up = a_key")).withColumn("before", F.col("before") + F.col("a_before"))
        above = level.select(F.col("grp").alias("a_grp"), F.col("key").alias("a_key"), F.col("before").alias("a_before"))
    return containers.join(above, F.expr("grp <=> a_grp AND high = a_key")).withColumn("before", F.col("a_before")).drop("a_grp", "a_key", "a_before", "n")


def _repeated(rows: DataFrame, others: Sequence[str]) -> DataFrame:
    """(grp, id, leaf, ..., pos) of rows whose id stands several times in its group, ``first`` being the id's coordinate.

    Copies of an id ascend by digest; equal rows take consecutive coordinates.
    """
    keys = ["grp", "id"]
    equal = rows.groupBy(*keys, "leaf", *others, "first").agg(F.count("*").alias("copies")).withColumn("part", F.substring("leaf", 1, 4))
    parts = equal.groupBy(*keys, "part").agg(F.sum("copies").alias("copies"))
    until = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"p_{k}") for k in keys], F.col("part").alias("p_part"),
                         F.coalesce(F.sum("copies").over(until.partitionBy(*keys)), F.lit(0)).alias("ahead"))
    near = Window.partitionBy(*keys, "part").orderBy("leaf", *others).rowsBetween(Window.unboundedPreceding, -1)
    placed = equal.withColumn("near", F.coalesce(F.sum("copies").over(near), F.lit(0))).join(parts, F.expr("grp <=> p_grp AND id <=> p_id AND part = p_part"))
    placed = placed.withColumn("from", F.col("first") + F.col("ahead") + F.col("near"))
    runs = placed.withColumn("run", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})"))).repartition("leaf", "run")
    one = F.explode(F.expr(f"sequence(run * {RUN}, least(copies, (run + 1) * {RUN}) - 1)"))
    return runs.select(*keys, "leaf", *others, "from", one.alias("copy")).select(*keys, "leaf", *others, (F.col("from") + F.col("copy")).alias("pos"))


def coordinates(leaves: DataFrame) -> DataFrame:
    """The rows (grp, id, leaf, ...) with ``pos``, their place among the leaves of their group, and ``n``, how many there are.

    Null ids come first.  Rows of one id ascend by digest.
    """
    others = [c for c in leaves.columns if c not in ("grp", "id", "leaf")]
    containers, totals = bitmaps(leaves.select("grp", "id"))
    totals = materialise(totals, "manifest-totals")
    held = containers.select(F.col("grp").alias("c_grp"), "high", "summary", "words", "ranks", "more", "before")
    joined = leaves.join(held, F.expr(f"grp <=> c_grp AND shiftright(id, {CONTAINER}) = high"), "left")
    joined = joined.join(totals.select(F.col("grp").alias("t_grp"), F.col("n").alias("n"), "n_null"), F.expr("grp <=> t_grp"))
    index = f"cast(bit_count(summary & {_low(f'shiftright(id, {WORD}) & 63')}) AS int)"
    low = f"(id & {(1 << CONTAINER) - 1})"
    rank = f"ranks[{index}] + bit_count(words[{index}] & {_low('id & 63')})"
    ahead = f"coalesce(aggregate(filter(more, m -> m.low < {low}), 0L, (s, m) -> s + m.n), 0L)"
    several = f"id IS NULL OR coalesce(exists(more, m -> m.low = {low}), false)"
    first = F.expr(f"CASE WHEN id IS NULL THEN 0L ELSE n_null + before + {rank} + {ahead} END")
    placed = materialise(joined.select("grp", "id", "leaf", *others, first.cast("long").alias("pos"), F.expr(several).alias("several")), "manifest-placed")
    single = placed.filter("NOT several").drop("several")
    again = _repeated(placed.filter("several").withColumnRenamed("pos", "first").drop("several"), others)
    out = single.unionByName(again)
    return out.join(totals.select(F.col("grp").alias("t_grp"), "n"), F.expr("grp <=> t_grp")).drop("t_grp")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of a block and the ``n`` levels above them."""
    out = [nodes]
    for _ in range(n):
        last = out[-1]
        out.append([_hash("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return out


def _depth(n: int, base: int) -> int:
    return max(0, min(LEVELS, (n - 1).bit_length() - base))


def _slots(nodes: pa.StructScalar | pa.Array) -> tuple[pa.Array, list[str]]:
    """The rows of a block in the order of their slots, and their digests."""
    slot = nodes.field("slot").to_numpy(zero_copy_only=False)
    order = np.empty(len(slot), np.int64)
    order[slot] = np.arange(len(slot))
    rows = nodes.take(pa.array(order))
    return rows, rows.field("leaf").to_pylist()


def _up(base: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n, nodes in zip(batch.column("n").to_pylist(), batch.column("nodes")):
                tops.append(levels_of(_slots(nodes.values)[1], _depth(n, base))[-1][0])
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), batch.column("n"), pa.array(tops, pa.string())], ["grp", "pos", "n", "leaf"])

    return work


def _down(base: int, names: Sequence[str]):
    """Rows of a block, each with its path: the siblings in the block, then those above."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above, counts = batch.column("path").to_pylist(), batch.column("n").to_pylist()
            for i, nodes in enumerate(batch.column("nodes")):
                rows, digests = _slots(nodes.values)
                levels = levels_of(digests, _depth(counts[i], base))[:-1]
                paths = []
                for s in range(len(digests)):
                    path = []
                    for level in levels:
                        other = s ^ 1
                        path.append(("<" if s & 1 else ">") + level[other] if other < len(level) else "")
                        s >>= 1
                    paths.append(path + above[i])
                first = batch.column("block")[i].as_py() << LEVELS
                columns = {"pos": pa.array(range(first, first + len(rows)), pa.int64()), "path": pa.array(paths, pa.list_(pa.string()))}
                for name in names:
                    if name not in columns:
                        inside = rows.type.get_field_index(name) >= 0
                        columns[name] = rows.field(name) if inside else batch.column(name).take(pa.array([i] * len(rows), pa.int64()))
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], list(names))

    return work


def _tree(nodes: DataFrame, others: Sequence[str]) -> tuple[DataFrame, list[DataFrame]]:
    """(grp, root) of every group of nodes (grp, pos, n, leaf, ...), and the written blocks of every round."""
    rounds, blocks = None, []
    while rounds is None or len(blocks) < rounds:
        base = LEVELS * len(blocks)
        inner = F.struct(F.expr(f"cast(pos & {(1 << LEVELS) - 1} AS int)").alias("slot"), "leaf", *(others if not blocks else []))
        made = nodes.groupBy("grp", F.expr(f"shiftright(pos, {LEVELS})").alias("block")).agg(F.max("n").alias("n"), F.collect_list(inner).alias("nodes"))
        blocks.append(materialise(made, f"manifest-blocks-{len(blocks)}"))
        if rounds is None:
            most = blocks[0].agg(F.max("n")).first()[0] or 1
            rounds = max(1, -(-(most - 1).bit_length() // LEVELS))
        nodes = blocks[-1].mapInArrow(_up(base), "grp string, pos long, n long, leaf string")
    return nodes.select("grp", F.col("leaf").alias("root")), blocks


def _paths(tops: DataFrame, blocks: list[DataFrame], carried: Sequence[str]) -> DataFrame:
    """Rows of the lowest blocks with their paths; ``tops`` has (grp, path) and the carried columns of every group."""
    paths = tops.withColumn("pos", F.lit(0).cast("long"))
    for r in reversed(range(len(blocks))):
        above = paths.select(F.col("grp").alias("a_grp"), F.col("pos").alias("a_pos"), "path", *carried)
        joined = blocks[r].join(above, F.expr("grp <=> a_grp AND block = a_pos")).drop("a_grp", "a_pos")
        inner = [f for f in blocks[r].schema["nodes"].dataType.elementType.fields if f.name != "slot"]
        schema = StructType([joined.schema["grp"], StructField("pos", blocks[r].schema["block"].dataType), StructField("n", blocks[r].schema["n"].dataType),
                             StructField("path", ArrayType(StringType())), *[joined.schema[c] for c in carried], *inner])
        paths = joined.mapInArrow(_down(LEVELS * r, schema.fieldNames()), schema)
    return paths


def manifest(df: DataFrame, digest: Column, id_col: str = "doc_id", group_col: str = "lang", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``df``: group, id, pos, n, leaf, path, subroot, root and the ``carry`` columns.

    ``digest`` is a row's leaf, ``id_col`` an integer and ``group_col`` a
    string column.  A group's leaves ascend by id; its subroot is what the
    levels leave, a lone leaf itself.  The subroots in the order of the groups
    (null first, then by bytes; a row a group) give the root in the same way.
    ``path`` leads from the leaf over the subroot to the root.

    Null ids come first in their group.  Rows of one id ascend by digest;
    equal rows stand side by side, each a leaf of its own.  An empty table
    gives no rows.  Other columns, whatever their names, have a part only if
    ``digest`` or ``carry`` use them; the latter's names must not be those above.
    """
    carry = carry or {}
    leaves = df.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("long").alias("id"), digest.alias("leaf"), *[c.alias(k) for k, c in carry.items()])
    others = ["id", *carry]
    subroots, blocks = _tree(coordinates(leaves), others)
    subroots = materialise(subroots, "manifest-subroots")
    order = Window.orderBy(F.col("grp").asc_nulls_first())
    numbered = subroots.select(F.lit("").alias("grp"), (F.row_number().over(order) - 1).cast("long").alias("pos"), F.count("*").over(Window.partitionBy()).alias("n"),
                               F.col("root").alias("leaf"), F.col("grp").alias("group"))
    root, upper = _tree(numbered, ["group"])
    top = root.select("grp", F.array().cast("array<string>").alias("path"), "root")
    groups = _paths(top, upper, ["root"]).select(F.col("group").alias("grp"), "path", F.col("leaf").alias("subroot"), "root")
    out = _paths(groups, blocks, ["subroot", "root"])
    return out.select(F.col("grp").alias("group"), "id", "pos", "n", "leaf", "path", "subroot", "root", *carry)
