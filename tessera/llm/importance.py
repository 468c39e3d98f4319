"""Importance resampling of raw text towards a target (Xie et al., 2023).

Two generative models of hashed word n-grams are counted, one over the target
texts and one over all texts.  A text's weight is the ratio of its likelihoods
under the two, and texts are sampled without replacement in proportion to
their weights by Gumbel top-k: each log weight gets independent Gumbel noise,
and the k largest sums are taken.  The k-th largest is found by counting, 16
bits of the key at a time, so nothing is sorted or collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, split_words, text_slices

#: Buckets of the hashed n-grams (single words and pairs of words).
BUCKETS = 10_000


def ngram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and every pair of neighbouring words; words in lower case."""
    import pyarrow.compute as pc
    import xxhash

    flat, offsets = split_words(pc.utf8_lower(texts))
    coded = flat.dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    same = doc[1:] == doc[:-1]
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:] >> np.uint64(1))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)
    bucket = np.concatenate([h % np.uint64(BUCKETS), pair[same] % np.uint64(BUCKETS)]).astype(np.int64)
    return bucket, np.concatenate([doc, doc[1:][same]])


def fit_ratio(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, target_rows: int = 100_000, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of the target's and the raw model's probability, for each bucket.

    ``target`` holds ids of the target texts; at most ``target_rows`` of them
    (the first by hash of the id) are used, so that they can be broadcast.  The
    raw model counts every text.  Without target texts all ratios are 0.
    """
    ids = target.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(target_rows)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(ids.withColumn("wanted", F.lit(True))), "id", "left").select("text", F.coalesce("wanted", F.lit(False)).alias("wanted"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in text_slices(batches, 0):
            bucket, doc = ngram_buckets(batch.column(0))
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[batch.column(1).to_numpy(zero_copy_only=False)[doc]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])], names=["bucket", "raw", "target"])

    counted = rows.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, wanted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counted.column("bucket").to_numpy()] = counted.column("raw").to_numpy()
    wanted[counted.column("bucket").to_numpy()] = counted.column("target").to_numpy()
    if not wanted.sum():
        return np.zeros(BUCKETS)
    return np.log((wanted + smoothing) / (wanted.sum() + smoothing * BUCKETS)) - np.log((raw + smoothing) / (raw.sum() + smoothing * BUCKETS))


def log_weights(df: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *, temperature: float = 1.0, seed: int = 0) -> DataFrame:
    """(id, log_weight, key, place): the key is the log weight over ``temperature`` plus Gumbel noise that depends on id, text and seed.

    ``place`` is a long that orders like the key.
    """
    shared = df.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            bucket, doc = ngram_buckets(batch.column(1))
            weight = np.bincount(doc, shared.value[bucket], batch.num_rows).astype(float)  # of an empty batch it counts in integers
            u = ((batch.column(2).to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
            key = weight / temperature - np.log(-np.log(u))
            bits = key.view(np.int64)
            place = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight), pa.array(key), pa.array(place)], names=["id", "log_weight", "key", "place"])

    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long"), text, F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text)).mapInArrow(run, "id long, log_weight double, key double, place long")


def kth_largest(df: DataFrame, column: str, k: int) -> int:
    """The k-th largest value of a long column, by counting 16 bits at a time."""
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        top = F.shiftright(column, shift)  # keeps the sign
        counts = df.filter(F.shiftright(column, shift + 16) == prefix) if shift < 48 else df
        bins = sorted(((r["b"], r["n"]) for r in counts.groupBy(top.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for b, n in bins:
            if left <= n:
                prefix = b
                break
            left -= n
    return prefix


def resample(df: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *, fraction: float = 0.5, temperature: float = 1.0, seed: int = 0) -> DataFrame:
    """(id, log_weight, key, selected), one row for each row of ``df``; the top ``fraction`` of all rows by key is selected.

    The number selected is the fraction of the row count, rounded down.  Rows
    of equal key at the border are taken by id.  Null, empty and wordless texts
    have log weight 0.  Null ids and repeated rows each give a row; equal rows
    have equal keys.  An empty table gives no rows.  Other columns are not read.
    """
    rows = materialise(log_weights(df, ratio, id_col, text_col, temperature=temperature, seed=seed), "importance-keys")
    k = int(fraction * rows.count())
    if not k:
        return rows.select("id", "log_weight", "key", F.lit(False).alias("selected"))
    least = kth_largest(rows, "place", k)
    border = rows.filter(F.col("place") == least)
    missing = k - rows.filter(F.col("place") > least).count()
    border = border.withColumn("selected", F.row_number().over(Window.partitionBy("place").orderBy("id")) <= missing)
    rest = rows.filter(F.col("place") != least).withColumn("selected", F.col("place") > least)
    return rest.unionByName(border).select("id", "log_weight", "key", "selected")
