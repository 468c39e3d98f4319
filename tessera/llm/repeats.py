"""Removal of long repeated passages with prefix-partitioned suffix trees.

A window is a run of ``window`` consecutive words of one text.  A word goes if
a window that covers it occurs anywhere else.

The corpus' suffixes are sampled by content: the anchor of a window is the
leftmost of its word runs of ``prefix`` words with the smallest hash, so equal
windows have their anchors at equal places, and neighbouring windows mostly
share theirs.  The windows of one anchor form a context.  Contexts are grouped
by the run at their anchor, the prefix.  A prefix that occurs once cannot lie
in a repeat, and contexts that occur again as a whole are repeats; only the
remaining ones of a group, with one of each repeated context as evidence, go
on with their words.  A group with too many different contexts is split by
longer prefixes, up to the whole window.  For each group a task builds the
tree of its suffixes (sorted, with the common prefix of neighbours); the
suffixes below internal nodes as deep as the window are the maximal repeats
that decide which windows occur again.

Hashes only choose what is compared by words, but for contexts that are equal
as a whole (two 64-bit hashes).  Texts are known by a 64-bit and a 32-bit
hash; equal texts are worked once in each task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, split_words, text_slices

#: Bits of a position that hold the number of windows of a context.
COUNT_BITS = 8
#: Different contexts of a group beyond which longer prefixes split it.
GROUP_CONTEXTS = 20_000


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + (b << np.uint64(23)) + (a >> np.uint64(17)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` items, by doubling."""
    out, done, power, size = None, 0, h, 1
    while True:
        if length & size:
            if out is None:
                out, done = power, size
            else:
                n = min(len(out), len(power) - done)
                out, done = _mix(out[: max(n, 0)], power[done : done + max(n, 0)]), done + size
        if 2 * size > length:
            return out
        n = max(len(power) - size, 0)
        power, size = _mix(power[:n], power[size : size + n]), 2 * size


def leftmost_min(values: np.ndarray, length: int) -> np.ndarray:
    """Index of the leftmost smallest value in each run of ``length`` values."""
    at, size = np.arange(len(values)), 1
    while size < length:
        step = min(size, length - size)
        n = max(len(at) - step, 0)
        left, right = at[:n], at[step : step + n]
        at, size = np.where(values[right] < values[left], right, left), size + step
    return at


def contexts_of(texts: pa.Array, window: int, prefix: int) -> dict[str, np.ndarray]:
    """The contexts of a batch of texts: text, first window, number of windows, hash of the prefix, hash of the context."""
    import xxhash

    flat, offsets = split_words(texts)
    empty = np.zeros(0, np.int64)
    if len(flat) < window:
        return {"text": empty, "first": empty, "count": empty, "h": empty, "c": empty}
    coded = flat.dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = known[coded.indices.to_numpy(zero_copy_only=False)]
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    prefixes, windows = run_hashes(h, prefix), run_hashes(h, window)
    anchor = leftmost_min(prefixes, window - prefix + 1)[: len(windows)]
    whole = np.flatnonzero(text[: len(windows)] == text[window - 1 : window - 1 + len(windows)])
    anchor, of = anchor[whole], text[whole]
    if not len(whole):
        return {"text": empty, "first": empty, "count": empty, "h": empty, "c": empty}
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])))
    last = np.append(new[1:], len(whole)) - 1
    first, end, a = whole[new], whole[last], anchor[new]
    shape = ((end - first) * 4096 + (a - first)).astype(np.uint64)
    c = _mix(_mix(windows[first], windows[end]), shape)
    return {"text": of[new], "first": first - offsets[of[new]], "count": end - first + 1, "h": prefixes[a].view(np.int64), "c": c.view(np.int64)}


def _occurrences(df: DataFrame, window: int, prefix: int) -> DataFrame:
    """Rows (route, c, n, th, crc, pos) of all contexts, equal ones of a batch added up.

    Of contexts that occur n > 1 times in the batch one row has n, with the
    prefix's hash as route, and the others have n = 0 and any route: they are
    known to occur again.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0, 6 << 20):
            keys = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], 1)
            _, one, times = np.unique(keys, axis=0, return_index=True, return_counts=True)
            found = contexts_of(batch.column(0).take(pa.array(one)), window, prefix)
            if not len(found["c"]):
                continue
            order = np.lexsort((found["c"], found["h"]))
            text, h, c = found["text"][order], found["h"][order], found["c"][order]
            pos = (found["first"] << COUNT_BITS | found["count"])[order]
            new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
            n = np.zeros(len(c), np.int64)
            n[new] = np.add.reduceat(times[text], np.flatnonzero(new))
            th, crc = keys[one[text], 0], keys[one[text], 1]
            # A context that is alone here because it stands in copies of one text is known to occur again, too.
            route = np.where(n > 0, h, th ^ pos)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (route, c, n.astype(np.int32), th, crc, pos)], names=["route", "c", "n", "th", "crc", "pos"])

    text = F.col("text")
    return df.select(text, F.xxhash64(text), F.crc32(text)).mapInArrow(run, "route long, c long, n int, th long, crc long, pos long")


def _judged(occurrences: DataFrame) -> DataFrame:
    """Rows (th, crc, pos, h, repeated, fetch, wide): contexts that occur again, and those whose words have to be compared."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        h, c, n, th, crc, pos = (table.column(k).to_numpy() for k in ("route", "c", "n", "th", "crc", "pos"))
        del table, batches
        alone = np.flatnonzero(n > 0)
        order = alone[np.lexsort((c[alone], h[alone]))]
        hs, cs, ns = h[order], c[order], n[order].astype(np.int64)
        if len(order):
            new_h = np.append(True, hs[1:] != hs[:-1])
            new_c = new_h | np.append(True, cs[1:] != cs[:-1])
            of_c, of_h = np.cumsum(new_c) - 1, np.cumsum(new_h) - 1
            times = np.bincount(of_c, ns).astype(np.int64)[of_c]
            total = np.bincount(of_h, ns).astype(np.int64)[of_h]
            contexts = np.bincount(of_h, new_c)[of_h]
            repeated, open_ = times > 1, (times == 1) & (total > 1)
            asked = np.bincount(of_h, open_)[of_h] > 0
            fetch, wide = asked & new_c, asked & (contexts > GROUP_CONTEXTS)
            keep = repeated | open_
        else:
            repeated = fetch = wide = keep = np.zeros(0, bool)
        sure = np.flatnonzero(n == 0)
        at, more = order[keep], np.zeros(len(sure), bool)
        cols = [np.concatenate([x[at], x[sure]]) for x in (th, crc, pos, h)]
        flags = [np.concatenate([x[keep], y]) for x, y in ((repeated, ~more), (fetch, more), (wide, more))]
        for i in range(0, len(cols[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000]) for x in (*cols, *flags)], names=["th", "crc", "pos", "h", "repeated", "fetch", "wide"])

    return occurrences.repartition("route").mapInArrow(run, "th long, crc long, pos long, h long, repeated boolean, fetch boolean, wide boolean")


def deep_leaves(suffixes: list[tuple[int, bytes, int]], depth: int) -> list[int]:
    """Owners of the suffixes below internal nodes of at least ``depth`` words.

    ``suffixes`` are (group, words with a blank after each, owner).  In sorted
    order the leaves of a node stand together, and a node is as deep as the
    common prefix of neighbours.
    """
    suffixes.sort()
    heads = []
    for group, words, _ in suffixes:
        end = -1
        for _ in range(depth):
            end = words.index(b" ", end + 1)
        heads.append((group, words[: end + 1]))
    out = []
    for i, head in enumerate(heads):
        if (i and heads[i - 1] == head) or (i + 1 < len(heads) and heads[i + 1] == head):
            out.append(suffixes[i][2])
    return out


def _compared(df: DataFrame, judged: DataFrame, window: int) -> DataFrame:
    """Rows (th, crc, pos) of single windows, in contexts to be compared, that occur again."""
    text = F.col("text")
    texts = df.select("id", F.xxhash64(text).alias("th"), F.crc32(text).alias("crc"), "text")
    # One document for each text, so that copies are not fetched again.
    wanted = judged.filter("fetch").groupBy("th", "crc").agg(F.collect_list(F.struct("pos", "h", "wide", "repeated")).alias("places"))
    holder = texts.drop("text").groupBy("th", "crc").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("holder"))
    wanted = materialise(wanted.join(holder, ["th", "crc"]).select("th", "crc", "places", F.col("holder.none").alias("none"), F.coalesce("holder.id", F.lit(0)).alias("key")), "repeats-wanted")
    fetched = texts.select("th", "crc", F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("key"), "text").join(wanted, ["th", "crc", "none", "key"]).select("text", "th", "crc", "places")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 8
            types = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["grp", "words", "count", "th", "crc", "first", "known", "wide"])

        out: list[tuple] = []
        for batch in text_slices(batches, 0):
            for text_, th, crc, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = text_.encode().split()
                for p in places:
                    first, count = p["pos"] >> COUNT_BITS, p["pos"] & ((1 << COUNT_BITS) - 1)
                    if not p["wide"]:
                        out.append((p["h"], b" ".join(words[first : first + count + window - 1]), count, th, crc, first, p["repeated"], False))
                        continue
                    for s in range(first, first + count):  # the longest prefix: the whole window
                        out.append((p["h"], b" ".join(words[s : s + window]), 1, th, crc, s, p["repeated"], True))
                if len(out) > 2000:
                    yield rows(out)
                    out = []
        yield rows(out)

    def trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: list[tuple[int, bytes, int]] = []
        owners: list[tuple[int, int, int, bool]] = []

        def grown() -> pa.RecordBatch:
            deep = [owners[i] for i in deep_leaves(suffixes, window)]
            rows = [(th, crc, s << COUNT_BITS | 1) for th, crc, s, known in deep if not known]
            suffixes.clear()
            owners.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["th", "crc", "pos"])

        last = None
        for batch in batches:
            for grp, words, count, th, crc, first, known in zip(*(c.to_pylist() for c in batch.columns[:7])):
                if grp != last and len(suffixes) > 20_000:  # as many whole groups as fit
                    yield grown()
                last, ends, words = grp, 0, words + b" "
                for s in range(count):
                    suffixes.append((grp, words[ends:], len(owners)))
                    owners.append((th, crc, first + s, known))
                    ends = words.index(b" ", ends) + 1
        yield grown()

    contexts = fetched.mapInArrow(cut, "grp long, words binary, count int, th long, crc long, first long, known boolean, wide boolean")
    if judged.filter("wide").isEmpty():
        return contexts.repartition("grp").sortWithinPartitions("grp").mapInArrow(trees, "th long, crc long, pos long")
    contexts = materialise(contexts, "repeats-contexts")
    near = contexts.filter("NOT wide").repartition("grp").sortWithinPartitions("grp").mapInArrow(trees, "th long, crc long, pos long")
    single = contexts.filter("wide")
    again = single.groupBy("words").agg(F.count("*").alias("n")).filter("n > 1").select("words")  # counted within each task first
    far = single.filter("NOT known").join(again, "words", "left_semi")
    return near.unionByName(far.select("th", "crc", F.expr(f"shiftleft(first, {COUNT_BITS}) | 1L").alias("pos")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 35, prefix: int = 16) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row of ``df``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word is removed if it
    lies in a run of ``window`` words of its text that also starts at another
    place of the corpus, the same text included.  All runs are judged on the
    input.  ``kept`` has the other words, joined by single blanks.

    Null, empty and short texts lose nothing; a null text has no words and an
    empty ``kept``.  Equal texts, repeated rows included, are places of their
    own, so a long text that occurs twice goes wholly.  Texts of any length
    are worked whole.  An empty table gives no rows.  Other columns are not read.
    """
    if not 1 <= prefix <= window or window - prefix >= 1 << COUNT_BITS:
        raise ValueError("prefix must be at most the window, and no more than 255 words shorter")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    judged = materialise(_judged(_occurrences(rows, window, prefix)), "repeats-judged")
    compared = _compared(rows, judged, window)
    places = judged.filter("repeated").select("th", "crc", "pos").unionByName(compared)
    places = materialise(places.groupBy("th", "crc").agg(F.collect_set("pos").alias("places")), "repeats-places")

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            out: list[tuple[int, int, bytes]] = []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                n = len(words)
                if places:
                    pos = np.array(places, np.int64)
                    first = pos >> COUNT_BITS
                    step = np.bincount(first, minlength=n + 1) - np.bincount(first + (pos & ((1 << COUNT_BITS) - 1)) + window - 1, minlength=n + 1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(step[:n]) == 0)]
                out.append((n, n - len(words), b" ".join(words).decode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                                             names=["id", "n_words", "n_removed", "kept"])

    joined = rows.select("id", "text", F.xxhash64("text").alias("th"), F.crc32("text").alias("crc")).join(places, ["th", "crc"], "left")
    return joined.select("id", "text", "places").mapInArrow(kept, "id long, n_words long, n_removed long, kept string")
