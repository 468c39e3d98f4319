import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.packing import pack_examples
from tests.llm.helpers import SF001, no_documents, odd_documents, odd_rows


def check(pieces, texts, capacity, max_segments, max_loss, prompts=None):
    """Every id of every text stands once in one sequence, within all limits; returns the padding."""
    encoder = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [np.array(encoder.encode(t or "", add_special_tokens=False).ids + [1], np.uint32) for _, t in texts]
    wanted = sorted((repr(d), len(i), zlib.crc32(i.tobytes())) for (d, _), i in zip(texts, ids))
    by_seq, crcs = {}, {}
    for i in ids:
        crcs.setdefault(len(i), []).append(i)
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append(p)
        assert any(zlib.crc32(i[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for i in crcs[p.doc_tokens])
    padding = 0
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        assert [p.offset for p in seq] == np.cumsum([0] + [p.length for p in seq])[:-1].tolist()
        total = sum(p.length for p in seq)
        assert total <= capacity and len(seq) <= max_segments and sum(p.loss_tokens for p in seq) <= max_loss
        padding += 0 if total & (total - 1) == 0 or total == capacity else capacity - total
    starts = {}
    for p in pieces:
        starts.setdefault((repr(p.doc_id), p.doc_tokens), []).append((p.start, p.length))
    assert sum(p.length for p in pieces) == sum(n for _, n, _ in wanted)
    for (d, n), parts in starts.items():
        times = sum(1 for w in wanted if w[:2] == (d, n))
        covered = np.bincount([x for s, l in parts for x in range(s, s + l)], minlength=n)
        assert (covered == times).all()
    return padding


def test_documents_are_packed_without_padding(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pieces = pack_examples(docs).collect()
    assert check(pieces, [(r.doc_id, r.text) for r in docs.collect()], 2048, 64, 2048) == 0


def test_three_limits_hold_together(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", F.pmod("doc_id", F.lit(7)).alias("p"))
    pieces = pack_examples(docs, prompt_tokens=F.col("p") * 40, capacity=512, max_segments=3, max_loss=300, pool=64).collect()
    check(pieces, [(r.doc_id, r.text) for r in docs.collect()], 512, 3, 300)
    assert all(p.loss_tokens == max(0, p.start + p.length - max(p.doc_id % 7 * 40, p.start)) for p in pieces)


def test_odd_documents(spark):
    assert check(pack_examples(odd_documents(spark)).collect(), [r[:2] for r in odd_rows()], 2048, 64, 2048) == 0


def test_encoder_equals_tokenizer_on_odd_white_space():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    import pyarrow as pa

    from tessera.llm.packing import Encoder

    fast, exact = Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    part = st.sampled_from(["a", "word", " ", "  ", "\n", "\t", " ", " ", "'s", "12", "é", "<|endoftext|>", ".", "\x0b", "\x1c", "\x85", "你"])

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(part, max_size=12).map("".join), min_size=1, max_size=4))
    def same(texts):
        assert [x.tolist() for x in fast.batch(pa.array(texts))] == [exact.encode(t, add_special_tokens=False).ids for t in texts]

    same()


def test_empty_table(spark):
    assert pack_examples(no_documents(spark)).count() == 0
