"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path

#: Bytes of text that a Python task unpacks at once; one longer text still comes whole.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor re-reads the written files, and
    every consumer sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return to the system what this process has freed.

    A Python worker lives on after its task, beside the executor's heap, and
    its allocators keep the largest size it ever had.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def text_slices(batches: Iterable[pa.RecordBatch], column: int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice hold about ``max_bytes``; no text is cut.

    Freed memory is given back after each batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        del batch, size, part
        give_back()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, flat, and the offsets of the texts among them.

    A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.bincount(owner[keep], minlength=len(texts)), out=offsets[1:])
    return (flat if keep.all() else flat.filter(full)), offsets
