"""Slices of texts, and memory that a worker gives back after them."""

import numpy as np
import psutil
import pyarrow as pa

from tessera.llm.common import give_back, text_slices


def test_slices_hold_every_row_once():
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string())], names=["text"]) for x in (["a" * 50, None, "b" * 500, ""], [], ["c"])]
    sliced = list(text_slices(iter(batches), 0, max_bytes=100))
    assert [t for b in sliced for t in b.column(0).to_pylist()] == ["a" * 50, None, "b" * 500, "", "c"] and len(sliced) > 2


def test_freed_memory_goes_back_to_the_system():
    """Many small blocks under one that stays: the allocator keeps them all without a trim."""
    me = psutil.Process()
    held = [np.ones(2_000) for _ in range(12_000)]  # 190 MB in blocks of 16 kB
    last = np.ones(2_000)
    full = me.memory_info().rss
    held.clear()
    give_back()
    assert last.sum() == 2_000 and full - me.memory_info().rss > 150e6
