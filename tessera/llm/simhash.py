"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``2 r`` bits exactly if some value
lies within ``r`` bits of both.  So every distinct fingerprint emits all
variants within ``r`` bits, and fingerprints that share a variant are linked.

The variant space is dealt out by the variants' leading bits: a fingerprint
goes to every region that holds some of its variants (its own leading bits
with up to ``r`` of them flipped), and the region's task makes the variants
there and sorts them.  The shuffle then carries one row for each fingerprint
and region instead of one for each variant.  A region too large for memory is
split by further bits.  All fingerprints that share a variant are within
``2 r`` of each other, so a chain through them keeps every connection without
emitting all pairs; each colliding pair in the chain is verified.

Exact copies, and other texts of equal fingerprint, count once from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, text_slices
from tessera.llm.components import components, local_roots

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Variants that a task holds at once, and variants that a region should have on average.
MEMORY_VARIANTS, REGION_VARIANTS = 4_000_000, 500_000


def fingerprint(text: bytes, shingle_words: int, seed: int = 42) -> int:
    """SimHash of a text: bit b is 1 if it is set in over half the shingles' XXH64 values."""
    import xxhash

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle_words, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, count, part = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 1 << 15
    for at in range(0, len(starts), part):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + part], ends[at : at + part])], np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, text_hash, fp) of every row; text_hash tells rows of equal id apart, fp is a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 2):
            seen: dict[bytes, int] = {}
            out = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(2).cast(pa.large_binary()).to_pylist()):
                text = text or b""
                if text not in seen:
                    seen[text] = fingerprint(text, shingle_words)
                out[i] = seen[text]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out.view(np.int64))], names=["id", "text_hash", "fp"])

    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long"), F.xxhash64(text), text).mapInArrow(run, "id long, text_hash long, fp long")


def flips(bits: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` of the lowest ``bits`` bits."""
    return [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(bits), k)]


def region_links(fps: np.ndarray, region: int, bits: int, radius: int, memory: int = MEMORY_VARIANTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between positions of ``fps`` (distinct, uint64) that share a variant whose leading ``bits`` bits are ``region``."""
    low = 64 - bits
    far = np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(region)) if bits else np.zeros(len(fps), np.uint8)
    at = [np.flatnonzero(far == j) for j in range(radius + 1)]
    total = sum(len(x) * math.comb(low, k) for j, x in enumerate(at) for k in range(radius - j + 1))
    if sum(map(len, at)) < 2:
        return
    if total > memory and low > 2:
        near = np.concatenate(at)
        for child in range(4):
            for a, b in region_links(fps[near], region * 4 + child, bits + 2, radius, memory):
                yield near[a], near[b]
        return
    rest = np.uint64((1 << low) - 1)
    variants, owners = [], []
    for j, x in enumerate(at):
        masks = np.array(flips(low, radius - j), np.uint64)
        variants.append(((fps[x] & rest)[:, None] ^ masks).ravel())
        owners.append(np.repeat(x, len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants)
    variants, owners = variants[order], owners[order]
    same = np.flatnonzero(variants[1:] == variants[:-1])
    pair = np.unique(owners[same] * len(fps) + owners[same + 1])
    yield pair // len(fps), pair % len(fps)


def link_classes(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, root) for the distinct fingerprints ``fp`` that link with another; root is the component's smallest."""
    radius = distance // 2
    n = classes.count()
    per_fp = sum(math.comb(64, k) for k in range(radius + 1))
    bits = min(30, max(4, math.ceil(math.log2(max(1, n * per_fp / REGION_VARIANTS)))))
    masks = F.array(*[F.lit(m) for m in flips(bits, radius)])
    dealt = classes.select("fp", F.explode(masks).alias("mask")).select(
        (F.shiftrightunsigned("fp", 64 - bits).bitwiseXOR(F.col("mask"))).alias("region"), "fp")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(rows.fp.to_numpy(np.int64).view(np.uint64))
        found = list(region_links(fps, int(key[0]), bits, radius))
        a, b = (np.concatenate([x[i] for x in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        ok = np.bitwise_count(fps[a] ^ fps[b]) <= distance
        root = local_roots(len(fps), a[ok], b[ok])
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked].view(np.int64), "b": fps[root[linked]].view(np.int64)})

    links = dealt.groupBy("region").applyInPandas(run, "a long, b long")
    return components(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One row for each row of ``df``: id, text_hash, fp, component_id, group_fp.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a
    shingle is ``shingle_words`` words, or the whole text if it has fewer.
    Rows link if their fingerprints differ in at most ``distance`` bits.
    ``component_id`` is the smallest id in the row's component and
    ``group_fp`` the component's smallest fingerprint.

    Null or empty texts have fingerprint 0 and link like any other.  A null id
    is never a component's id unless the component has no other; then it is
    null.  Repeated rows each give a row.  An empty table gives no rows.
    Other columns are not read.  ``distance`` must be even: half of it is the
    radius of the variants.
    """
    if distance < 0 or distance % 2:
        raise ValueError("distance must be even")
    rows = materialise(fingerprints(df, id_col, text_col, shingle_words), "simhash-rows")
    classes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = link_classes(classes, distance)
    grouped = materialise(classes.join(roots, "fp", "left").withColumn("group_fp", F.coalesce("root", "fp")), "simhash-groups")
    least = grouped.groupBy("group_fp").agg(F.min("least").alias("component_id"))
    known = materialise(grouped.select("fp", "group_fp").join(least, "group_fp"), "simhash-known")
    return rows.join(known, "fp").select("id", "text_hash", "fp", "component_id", "group_fp")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``df`` without near-duplicates: one row of each component stays, all columns unchanged.

    The one with the smallest id stays (null ids last), of equal ids the one
    with the smallest text hash, and of wholly equal rows any one.
    """
    found = near_duplicates(df, id_col, text_col, shingle_words, distance)
    first = found.groupBy("group_fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("r"))
    same = found.groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    key = F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "text_hash")
    stay = materialise(
        first.select("r.id", "r.text_hash").withColumn("key", key).drop("id", "text_hash")
        .join(same.withColumn("key", key).select("key", "n"), "key").select("key.*", F.col("n").alias("__n")), "simhash-stay")
    text = F.col(text_col).cast("string")
    # Names that the table cannot clash with.
    tagged = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), F.col(id_col).cast("long").alias("i"), F.xxhash64(text).alias("text_hash")).select(
        "row", F.col("i").isNull().alias("none"), F.coalesce("i", F.lit(0)).alias("id"), "text_hash")
    kept = tagged.join(stay, ["none", "id", "text_hash"])
    once = kept.filter(F.col("__n") == 1).select("row.*")
    again = kept.filter(F.col("__n") > 1).dropDuplicates(["none", "id", "text_hash"]).select("row.*")
    return once.unionByName(again)
