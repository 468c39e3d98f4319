"""Vector bin packing of tokenised examples into fixed-length training sequences.

An example is a vector (tokens, segments, loss-bearing tokens) and a sequence
is a bin with a limit in each dimension.  Bins are filled by the dot-product
heuristic (Panigrahy et al., "Heuristics for Vector Bin Packing", 2011): the
next piece is the one whose demand vector has the largest product with the
bin's remaining capacity, each dimension weighted by its mean demand.  When no
whole piece fits, the best one is cut to fill the gap.

Every scan task tokenises and packs its own rows, so nothing is shuffled.  A
task holds a bounded pool of pieces: long examples give off full sequences at
once, and bins are closed whenever the pool is full.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_slices

#: White space as the pre-tokeniser's \s sees it; a blank before one of these is not a word's own blank.
SPACES = "[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
SPECIAL = "<|endoftext|>"
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


class Encoder:
    """Ids of the byte-level BPE vocabulary, a batch of texts at a time.

    A blank followed by a non-blank begins a new pre-token, so a text's ids are
    those of its blank-separated chunks in turn.  The distinct chunks of a
    batch are encoded once, as one string with tabs between them; a tab before
    a blank is a pre-token of its own.  Texts with other runs of white space
    are encoded whole, and text that holds the special token's string goes
    through the tokenizer file itself, which maps that string to its id.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tab, self.json_path, self.exact = ranks[b"\t"], json_path, None

    def one(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return np.asarray(self.fast.encode_ordinary(text), np.uint32)
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.json_path)
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def chunks(self, chunks: pa.Array, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all distinct chunks, flat, and each chunk's count and place; ``blank`` marks those with a blank before."""
        alone = ~blank | pc.match_substring_regex(chunks, "\t|<\\|endoftext\\|>|" + SPACES + "$").to_numpy(zero_copy_only=False)
        sizes, order, parts = np.zeros(len(chunks), np.int64), [], []
        joined = np.flatnonzero(~alone)
        if len(joined):
            together = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), chunks.take(pa.array(joined))), "\t ")[0]
            ids = np.asarray(self.fast.encode_ordinary(" " + together.as_py()), np.uint32)
            stops = np.append(np.flatnonzero(ids == self.tab), len(ids))
            sizes[joined] = np.diff(stops, prepend=-1) - 1
            order.append(joined)
            parts.append(ids[ids != self.tab])
        single = np.flatnonzero(alone)
        for i, text in zip(single.tolist(), chunks.take(pa.array(single)).to_pylist()):
            parts.append(self.one(" " + text if blank[i] else text))
            sizes[i] = len(parts[-1])
        order.append(single)
        order = np.concatenate(order)
        at = np.empty(len(chunks), np.int64)
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(parts), sizes, at

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """One array of ids (uint32) for each text; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, " " + SPACES).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends, words = np.cumsum(lengths), len(coded.dictionary)
        first = ends - lengths
        codes[first] += words  # the first chunk of a text has no blank before it
        used = np.flatnonzero(np.bincount(codes, minlength=2 * words))
        place = np.zeros(2 * words, np.int64)
        place[used] = np.arange(len(used))
        codes = place[codes]
        table, sizes, at = self.chunks(coded.dictionary.take(pa.array(used % words)), used < words)
        count = sizes[codes]
        stops = np.cumsum(count)
        flat = table[np.repeat(at[codes] - (stops - count), count) + np.arange(stops[-1])]
        stops = np.concatenate([[0], stops])
        out = [flat[stops[a] : stops[b]] for a, b in zip(first.tolist(), ends.tolist())]
        for i in np.flatnonzero(odd):
            out[i] = self.one(texts[i].as_py())
        return out


class Packer:
    """Packs the pieces of one task.  ``out`` gets (piece, sequence number, offset)."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, pool: int):
        self.capacity, self.max_segments, self.max_loss, self.pool = capacity, max_segments, max_loss, pool
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.pieces: list[tuple] = []  # (example, start, length, first loss-bearing index)
        self.demand = np.zeros((3, 0))
        self.fresh: list[tuple] = []
        self.out: list[tuple] = []
        self.sequence = 0

    def loss(self, start: int, length: int, first: int) -> int:
        return max(0, start + length - max(first, start))

    def longest(self, start: int, length: int, first: int, room: int, loss_room: int) -> int:
        """The longest head of a piece that fits the room for tokens and loss-bearing tokens."""
        return min(length, room, max(first - start, 0) + loss_room)

    def add(self, example, length: int, first: int) -> None:
        start = 0
        while (head := self.longest(start, length - start, first, self.capacity, self.max_loss)) < length - start or head == self.capacity:
            self.emit([(example, start, head, first)])
            start += head
            if start == length:
                return
        self.fresh.append((example, start, length - start, first))
        if len(self.fresh) + len(self.pieces) >= self.pool:
            self.close_bins(self.pool // 2)

    def emit(self, bin_: list[tuple]) -> None:
        """Close a sequence.  One that is neither full nor a power of two is cut at powers of two."""
        total = sum(p[2] for p in bin_)
        room = total if total == self.capacity else 1 << (total.bit_length() - 1)
        rest, offset = total, 0
        for example, start, length, first in bin_:
            while length:
                take = min(length, room - offset)
                self.out.append((example, start, take, self.loss(start, take, first), self.sequence, offset))
                start, length, offset, rest = start + take, length - take, offset + take, rest - take
                if offset == room:
                    self.sequence, offset = self.sequence + 1, 0
                    room = 1 << (rest.bit_length() - 1) if rest else 0

    def close_bins(self, leave: int) -> None:
        """Fill bins until at most ``leave`` pieces wait."""
        self.pieces += self.fresh
        pieces = self.pieces
        new = np.array([(p[2], 1, self.loss(*p[1:])) for p in self.fresh], float).reshape(-1, 3).T
        self.demand, self.fresh = np.concatenate([self.demand, new], 1), []
        demand, waiting = self.demand, np.ones(len(pieces), bool)
        left = len(pieces)
        weight = demand.mean(1) / self.limits**2 if left else None
        while left > leave:
            room, bin_ = self.limits.copy(), []
            while left and room[0] > 0 and room[1] > 0 and room[2] >= 0:
                value = np.where(waiting, (weight * room) @ demand, -1.0)
                fits = (demand <= room[:, None]).all(0) & waiting
                if fits.any():
                    best = int(np.argmax(np.where(fits, value, -1.0)))
                    bin_.append(pieces[best])
                    room -= demand[:, best]
                    waiting[best] = False
                    left -= 1
                    continue
                best = int(np.argmax(value))
                example, start, length, first = pieces[best]
                head = self.longest(start, length, first, int(room[0]), int(room[2]))
                if head:
                    bin_.append((example, start, head, first))
                    pieces[best] = (example, start + head, length - head, first)
                    demand[:, best] = (length - head, 1, self.loss(start + head, length - head, first))
                break
            self.emit(bin_)
        self.pieces, self.demand = [p for p, w in zip(pieces, waiting) if w], demand[:, waiting]


def pack_examples(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prompt_tokens: Column | None = None, *,
                  json_path: str | None = None, ranks_path: str | None = None, pattern: str | None = None, end_id: int = 1,
                  capacity: int = 2048, max_segments: int = 64, max_loss: int | None = None, pool: int = 1024) -> DataFrame:
    """One row for each piece of the packed sequences.

    An example's ids are those of its text, then ``end_id``.  Its first
    ``prompt_tokens`` ids (default 0) bear no loss.  A sequence holds at most
    ``capacity`` ids, ``max_segments`` pieces and ``max_loss`` loss-bearing
    ids (default: the capacity).  Sequences that would be left with a gap are
    cut at powers of two, so they need no padding.

    Null or empty text: the end id alone.  Null prompt: 0.  A null id stays
    null.  Texts of any length are cut into as many sequences as they need.
    Repeated rows are packed each for itself.  An empty table gives no rows.
    Other columns are not read.  Sequence ids are unique, not consecutive: the
    task's number, then a count; they follow the layout of the input files.
    """
    if json_path is None or ranks_path is None or pattern is None:
        import public_tokenizers as P

        json_path, ranks_path = json_path or P.path("byte_bpe_50k.json"), ranks_path or P.path("byte_bpe_50k.tiktoken")
        pattern = pattern or P.PATTERN
    max_loss = capacity if max_loss is None else max_loss
    if min(capacity, max_segments, max_loss) < 1:
        raise ValueError("capacity, max_segments and max_loss must be positive")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(json_path, ranks_path, pattern), Packer(capacity, max_segments, max_loss, pool)
        base = TaskContext.get().partitionId() << 32

        def rows() -> pa.RecordBatch:
            done, packer.out = packer.out, []
            cols = [[], [], [], [], [], [], [], []]
            for (doc, ids), start, length, loss, seq, offset in done:
                for col, x in zip(cols, (doc, start, length, zlib.crc32(ids[start : start + length]), len(ids), base + seq, offset, loss)):
                    col.append(x)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])

        for batch in text_slices(batches, 1):
            for doc, first, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), encoder.batch(batch.column(1))):
                packer.add((doc, np.append(ids, np.uint32(end_id))), len(ids) + 1, max(first or 0, 0))
            if len(packer.out) >= 5000:
                yield rows()
        packer.close_bins(0)
        yield rows()

    first = F.lit(0) if prompt_tokens is None else prompt_tokens
    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), first.cast("long")).mapInArrow(run, PIECE_SCHEMA)
