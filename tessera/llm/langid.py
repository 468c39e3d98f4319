"""Language spans of mixed text: script ranges, word scores, Viterbi over the words.

A word's script (by Unicode ranges) narrows its candidate languages to those
that were seen in that script; letters of no listed range are one more script,
and where no language was seen, all are candidates.  Among them it scores by the log-probability of
its letter runs under each language's model.  A text's words then get the
sequence of languages with the best total score, where every change of
language costs a penalty; equal neighbours form spans.  The text's language is
the one whose spans hold most letters.

The models are counts over all training rows, added up by Spark: a fixed
number of hashed buckets for each language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import split_words, text_slices

# First and last code points of scripts' letters.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x591, 0x5F4)],
    "arabic": [(0x620, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
}
SCRIPTS = list(SCRIPT_RANGES)
#: Buckets of hashed letter runs, the lengths of the runs in bytes, and the bucket of each script's word count.
BUCKETS, RUNS = 1 << 16, (2, 3, 4, 5)
#: A language is written in a script that holds this share of its training words.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"


def _script_table() -> tuple[np.ndarray, np.ndarray]:
    """Ascending bounds, and the script (1 and up, 0: none) from each bound on."""
    spans = sorted((a, b, 1 + i) for i, s in enumerate(SCRIPTS) for a, b in SCRIPT_RANGES[s])
    bounds, of = [0], [0]
    for a, b, i in spans:
        bounds += [a, b + 1]
        of += [i, 0]
    return np.array(bounds), np.array(of)


@dataclass
class WordTable:
    """Distinct lower-case words of a batch: script, length, and (bucket, word) of their letter runs."""

    script: np.ndarray
    letter: np.ndarray
    length: np.ndarray
    bucket: np.ndarray
    owner: np.ndarray


def word_table(words: pa.Array) -> WordTable:
    words = pc.utf8_lower(words)
    n = len(words)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = " ".join(words.to_pylist()) if n else ""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    bounds, of = _script_table()
    script_at = of[np.searchsorted(bounds, points, side="right") - 1] if n else np.zeros(0, np.int64)
    owner_at = np.repeat(np.arange(n), length + 1)[: len(points)]
    script = np.zeros(n, np.int64)
    found = np.flatnonzero(script_at)[::-1]
    script[owner_at[found]] = script_at[found]  # the first letter's, as it is written last
    letter = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False) if n else np.zeros(0, bool)
    raw = np.frombuffer(b" " + joined.encode() + b" ", np.uint8).astype(np.uint64)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    stop = np.cumsum(size + 1)  # place of the blank behind each word
    owner_of = np.repeat(np.arange(n), size + 1)
    buckets, owners = [], []
    for k in RUNS:
        starts = np.arange(len(owner_of))
        starts = starts[(starts + k - 1 <= stop[owner_of]) & letter[owner_of]] if n else starts
        h = np.full(len(starts), k, np.uint64)
        for j in range(k):
            h = (h * np.uint64(0x100000001B3)) ^ raw[starts + j]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        buckets.append((h >> np.uint64(48)).astype(np.int32))
        owners.append(owner_of[starts].astype(np.int32))
    return WordTable(script, letter, length, np.concatenate(buckets), np.concatenate(owners))


@dataclass
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray  # (BUCKETS, languages)
    written: np.ndarray  # (scripts + 1, languages): is the language written in the script
    penalty: float
    scale: float


def fit_languages(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, where: Column | None = None,
                  penalty: float = 8.0, scale: float = 0.25, smoothing: float = 0.5) -> LanguageModel:
    """Models of the languages of ``df``'s rows (those of ``where``), all rows counted.

    Rows without text or language are left out.  Without rows the model knows
    no language.  ``scale`` weighs the letter runs of a word, which overlap.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    n_buckets = BUCKETS + len(SCRIPTS) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, 0):
            flat, offsets = split_words(batch.column(0))
            words = flat.dictionary_encode()
            table, codes = word_table(words.dictionary), words.indices.to_numpy(zero_copy_only=False)
            langs = batch.column(1).dictionary_encode()
            lang_of = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(offsets))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(codes[lang_of == i], minlength=len(table.script)).astype(float)
                counts = total.setdefault(lang, np.zeros(n_buckets))
                counts[:BUCKETS] += np.bincount(table.bucket, times[table.owner], BUCKETS)
                counts[BUCKETS:] += np.bincount(table.script, times * (table.letter | (table.script > 0)), len(SCRIPTS) + 1)
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at].astype(np.int64))], names=["lang", "bucket", "n"])

    counted = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counted.column("lang").to_pylist()))
    counts = np.zeros((n_buckets, len(languages)))
    if languages:
        place = pc.index_in(counted.column("lang"), pa.array(languages)).to_numpy()
        counts[counted.column("bucket").to_numpy(), place] = counted.column("n").to_numpy()
    runs, scripts = counts[:BUCKETS], counts[BUCKETS:]
    log_p = np.log((runs + smoothing) / (runs.sum(0) + smoothing * BUCKETS)).astype(np.float32)
    written = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(0))
    return LanguageModel(languages, log_p, written, penalty, scale)


def word_scores(table: WordTable, log_p: np.ndarray, written: np.ndarray, scale: float) -> np.ndarray:
    """Score of each distinct word under each language; a word without letters scores 0 everywhere, one without candidates by its letter runs alone."""
    n, languages = len(table.script), log_p.shape[1]
    out = np.zeros((n, languages))
    for k in range(languages):
        out[:, k] = np.bincount(table.owner, log_p[table.bucket, k], n) * scale
    fits = written[table.script]
    out[~fits & fits.any(1)[:, None]] -= 1e4
    out[~table.letter] = 0
    return out


def viterbi(scores: np.ndarray, word: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word of every text; all texts of the batch advance together.

    Text d holds the words ``word[offsets[d]:offsets[d + 1]]``.
    """
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")
    starts, length = offsets[:-1][order], length[order]
    active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")  # texts longer than t
    languages = scores.shape[1]
    stay = np.zeros((len(word), languages), bool)
    source = np.zeros(len(word), np.int16)
    path = np.zeros(len(word), np.int16)
    if not len(word):
        return path
    total = scores[word[starts[: active[0]]]].copy()
    for t in range(1, len(active)):
        n = active[t]
        at, before = starts[:n] + t, total[:n]
        best = before.argmax(1)
        switched = before[np.arange(n), best] - penalty
        keep = before >= switched[:, None]
        stay[at], source[at] = keep, best
        total[:n] = np.where(keep, before, switched[:, None]) + scores[word[at]]
    now = total.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at, lang = starts[:n] + t, now[:n]
        path[at] = lang
        now[:n] = np.where(stay[at, lang], lang, source[at])
    return path


def label_languages(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans) of every row of ``df``.

    ``spans`` are (lang, first_word, n_words) in order, over the words
    ``[^\\x20\\x09-\\x0D]+``.  ``lang_pred`` is the language whose spans hold
    most letters (of equal ones the first in code point order), ``score`` its
    share of them.

    A null text, or one without a letter, gets ``und`` and score 0; so does
    every text if the model knows no language.  Texts of any length are
    labelled whole.  Null ids and repeated rows each give a row.  Other columns
    are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.log_p, model.written, model.penalty, model.scale))
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_p, written, penalty, scale = shared.value
        names = pa.array([*languages, UNKNOWN])
        for batch in text_slices(batches, 1):
            n = batch.num_rows
            flat, offsets = split_words(batch.column(1))
            words = flat.dictionary_encode()
            word, table = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), word_table(words.dictionary)
            doc = np.repeat(np.arange(n), np.diff(offsets))
            weight = np.where(table.letter, table.length, 0)[word]
            if languages:
                path = viterbi(word_scores(table, log_p, written, scale), word, offsets, penalty)
                held = np.bincount(doc * len(languages) + path, weight, n * len(languages)).reshape(n, -1)
                best, letters = held.argmax(1), held.sum(1)
                score = np.where(letters > 0, held[np.arange(n), best] / np.maximum(letters, 1), 0.0)
                best = np.where(letters > 0, best, len(languages))
                new = np.append(True, (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])) if len(word) else np.zeros(0, bool)
                first = np.flatnonzero(new)
            else:
                path, best, score, first = np.zeros(0, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(word))) if len(first) else np.zeros(0, np.int64)
            parts = pa.StructArray.from_arrays([names.take(pa.array(path[first].astype(np.int64))), pa.array(first - offsets[doc[first]]), pa.array(count)], fields=list(span))
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), names.take(pa.array(best)), pa.array(score), pa.ListArray.from_arrays(pa.array(ends), parts)], names=["id", "lang_pred", "score", "spans"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")).mapInArrow(
        run, "id long, lang_pred string, score double, spans array<struct<lang: string, first_word: long, n_words: long>>")
