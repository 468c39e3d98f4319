"""Toxicity scores with noisy-channel deobfuscation.

Words written in look-alike characters, with separators, spaced letters or
repeated letters are restored first: their characters span a lattice (a
look-alike may be one of several letters, a separator or a repetition may be
nothing, a blank nothing or a word's edge), and Viterbi decoding finds the cheapest path under the channel's
costs and a character language model counted over the whole corpus.  The
restored words are then scored.

The score rests on log-odds of words and word beginnings, by the number of
labelled documents of either class that hold them, and a logistic function of
a document's strongest evidence, fitted on labelled documents that the
log-odds have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import split_words, text_slices

#: Letters that a character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = "._-~'`*,:;/\\­​‌‍⁠"
EDGES = " #.,;:?!\"'()[]{}<>«»„“”’…-_"
#: Costs of the channel, in nats: a look-alike, a dropped separator, the second of a letter dropped, a further one, a letter for a star, another character left out.
LOOK, DROP, REPEAT, MORE, STAR, OTHER = 0.3, 0.1, 1.5, 0.2, 1.5, 6.0
#: States up to which they are held one by one, and characters between the kept costs of a long word.
FEW, STRIDE = 128, 64
#: Bytes of text that a task counts characters of, and restores words of, at once.
COUNT_BYTES, WORD_BYTES = 1 << 20, 2 << 20
#: Characters of the language model: a word's edge, the letters a to z, any other letter.
EDGE, SYMBOLS, ORDER = 0, 28, 4
#: Lengths of the word beginnings that are features beside the whole word; a beginning carries its length as a mark.
BEGINNINGS = (4, 5, 6)

CODES = np.zeros(256, np.int64)
for _i, _c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
    CODES[_c] = CODES[_c - 32] = _i + 1
CODES[128:] = 27
_DOUBLE = "|".join(c * 2 for c in "abcdefghijklmnopqrstuvwxyz")
_LOOK, _BREAK = "0-9@$!|+(<€£¡*", r"._\-~'`*,:;/\\\x{ad}\x{200b}-\x{200d}\x{2060}\p{Z}"
#: A word that needs decoding: a look-alike beside a letter, any run of separators between them, or a letter twice.
NOISY = f"[a-z][{_BREAK}]*[{_LOOK}]|[{_LOOK}][{_BREAK}]*[a-z]|[a-z][{_BREAK}]+[a-z]|{_DOUBLE}"
#: Decoration at a word's end that stands for no letter.
TAIL = r"(?:[#*!|~^=+.,:;?]|\${3,})+$"


def crc_mod(id_: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % mod


# ---- character language model

def character_counts(df: DataFrame, text_col: str) -> np.ndarray:
    """Counts of all runs of ORDER symbols in the texts of ``df``; their number is bounded by the alphabet."""
    size = SYMBOLS**ORDER

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in text_slices(batches, 0, COUNT_BYTES):
            # A line end between texts; UTF-8 continuation bytes are left out, so a letter is one symbol.
            joined = "\n".join(t for t in batch.column(0).to_pylist() if t)
            raw = np.frombuffer(f"\n{joined}\n".encode(), np.uint8)
            codes = CODES[raw[(raw & 0xC0) != 0x80]]
            codes = codes[np.append(True, (codes[1:] != EDGE) | (codes[:-1] != EDGE))]
            codes = np.repeat(codes, np.where(codes == EDGE, ORDER - 1, 1))  # full context at a word's beginning
            runs = len(codes) - ORDER + 1
            if runs > 0:
                total += np.bincount(sum(codes[k : k + runs] * SYMBOLS ** (ORDER - 1 - k) for k in range(ORDER)), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["run", "n"])

    rows = df.select(F.col(text_col).cast("string")).mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("run").to_numpy()] = rows.column("n").to_numpy()
    return out


def character_model(counts: np.ndarray, strength: float = 5.0) -> np.ndarray:
    """Natural log of P(symbol | ORDER - 1 symbols before), interpolated down to single symbols."""
    table = counts.reshape((SYMBOLS,) * ORDER).astype(float)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(ORDER):
        n = table.sum(axis=tuple(range(ORDER - 1 - k)))
        p = (n + strength * p) / (n.sum(-1, keepdims=True) + strength)
    return np.log(p).reshape(-1, SYMBOLS).astype(np.float32)


def lattice(word: str) -> Iterator[list[tuple[str, float]]]:
    """For each character the letters that it may stand for, with their costs; "" leaves it out, a blank is a word's edge."""
    before, times = "", 0
    for c in word:
        hidden = c in SEPARATORS or c == " "  # a letter counts as repeated across these
        times = times if hidden else times + 1 if c == before else 1
        again = [] if times == 1 else [("", REPEAT if times == 2 else MORE)]
        if "a" <= c <= "z":
            yield [(c, 0.0), *again]
        elif c in LOOKALIKES:
            yield [*((x, LOOK) for x in LOOKALIKES[c]), *again, ("", OTHER)]
        elif c == "*":
            yield [(x, STAR) for x in "abcdefghijklmnopqrstuvwxyz"] + [("", DROP)]
        elif c == " ":
            yield [("", DROP), (" ", 0.0)]
        elif c in SEPARATORS:
            yield [("", DROP)]
        else:
            yield [(c, 0.0)] if c.isalpha() else [("", OTHER)]
        before = before if hidden else c


def _symbol(x: str) -> int:
    return ord(x) - 96 if "a" <= x <= "z" else 27


def stars_used(model: np.ndarray) -> int:
    """Stars of one run that can stand for letters in a cheapest path.

    A letter for a star costs STAR - DROP more than leaving the star out, at
    least.  What letters before it save is confined to the ORDER - 1 symbols
    that see them, so more letters than this never pay.
    """
    widest = float((model.max(axis=0) - model.min(axis=0)).max())
    return int((ORDER - 1) * widest / (STAR - DROP)) + 1


def decode(word: str, model: np.ndarray) -> str:
    """The most likely letters behind an obfuscated word, lower case; blanks stand between words if there are several.

    Exact: every state of the lattice is kept, in arrays once there are many.
    A run of stars longer than a cheapest path can use is worked at that length.
    """
    word = " ".join(word.lower().split())
    if "*" * 16 in word:
        word = re.sub(r"\*+", lambda m: m.group()[: stars_used(model)], word)
    wrap = SYMBOLS ** (ORDER - 1)
    # Each state's cost and letters, the last one first: (letter, (letter before, ...)).
    states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for options in lattice(word):
        best: dict[int, tuple[float, tuple]] = {}
        for state, (cost, out) in states.items():
            for x, extra in options:
                if x == " ":
                    if not state:
                        continue  # no word before this edge
                    new, total = 0, cost + extra - float(model[state, EDGE])
                elif x:
                    symbol = _symbol(x)
                    new, total = (state * SYMBOLS + symbol) % wrap, cost + extra - float(model[state, symbol])
                else:
                    new, total = state, cost + extra
                if new not in best or total < best[new][0]:
                    best[new] = (total, (x, out) if x else out)
        states = best
        if len(states) > FEW:
            return _decode_dense(list(lattice(word)), model)
    _, out = min(((cost - float(model[s, EDGE]) if s or not out else cost, out) for s, (cost, out) in states.items()), key=lambda s: s[0])
    letters = []
    while out:
        letters.append(out[0])
        out = out[1]
    return "".join(reversed(letters)).strip()


def _forward(cost: np.ndarray, options: list[tuple[str, float]], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of all states after a character, and the state and the option that each came by."""
    rest = SYMBOLS ** (ORDER - 2)
    new, parent, chosen = np.full(len(cost), np.inf), np.zeros(len(cost), np.int32), np.zeros(len(cost), np.int8)
    for k, (x, extra) in enumerate(options):
        if x == " ":
            ended = cost[1:] + extra - model[1:, EDGE]
            at = int(np.argmin(ended))
            if ended[at] < new[0]:
                new[0], parent[0], chosen[0] = ended[at], at + 1, k
        elif x:
            total = (cost + extra - model[:, _symbol(x)]).reshape(SYMBOLS, rest)
            first = np.argmin(total, axis=0)
            least, to = total[first, np.arange(rest)], np.arange(rest) * SYMBOLS + _symbol(x)
            better = least < new[to]
            new[to[better]], parent[to[better]], chosen[to[better]] = least[better], (first * rest + np.arange(rest))[better], k
        else:
            better = cost + extra < new
            new[better], parent[better], chosen[better] = (cost + extra)[better], np.flatnonzero(better), k
    return new, parent, chosen


def _decode_dense(steps: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """``decode`` over arrays of all states; costs are kept every STRIDE characters, and what lies between is worked again on the way back."""
    start = np.full(len(model), np.inf)
    start[0] = 0.0
    kept, cost, none = [start], start, True
    for i, options in enumerate(steps, 1):
        cost, _, chosen = _forward(cost, options, model)
        none = none and options[chosen[0]][0] == ""  # state 0 without a letter before it
        if i % STRIDE == 0:
            kept.append(cost)
    final = cost - model[:, EDGE]
    final[0] = final[0] if none else cost[0]
    state, letters = int(np.argmin(final)), []
    for a in reversed(range(0, len(steps), STRIDE)):
        cost, back = kept[a // STRIDE], []
        for options in steps[a:a + STRIDE]:
            cost, parent, chosen = _forward(cost, options, model)
            back.append((parent, chosen))
        for options, (parent, chosen) in zip(reversed(steps[a:a + STRIDE]), reversed(back)):
            letters.append(options[chosen[state]][0])
            state = int(parent[state])
    return "".join(reversed(letters)).strip()


# ---- words of texts, restored

@dataclass
class Words:
    """Distinct words of a batch, lower case, trimmed and restored; (doc, word) tells which documents hold which."""

    words: pa.Array
    doc: np.ndarray
    word: np.ndarray


_MARKS = "".join(f"\\{c}" if c in "#.,-;:?\"')[]{}>'`~/\\" else c for c in dict.fromkeys(EDGES + SEPARATORS) if c not in " !(<*")
_SIGNS = "@$!|+(<€£¡*"
#: A run of single characters: white space, and maybe marks, between any two of them.
_SINGLE = rf"(?:[^\W_]|[{_SIGNS}])"
_SPACED = re.compile(rf"(?<![^\W_]){_SINGLE}(?:[!|+*]{{0,8}}[{_MARKS}]*\s[{_MARKS}\s]*{_SINGLE})+(?![^\W_])")
#: A text that may hold such a run.
SPACED = rf"(?:^|[^\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}{_SIGNS}][!|+*]{{0,8}}[{_MARKS}]*[\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}][{_MARKS}\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]*[\p{{L}}\p{{N}}{_SIGNS}](?:$|[^\p{{L}}\p{{N}}])"


def spaced_runs(text: str) -> Iterator[str]:
    """The runs of single characters: two or more with white space alone between them, or four or more."""
    for run in _SPACED.findall(text):
        parts = run.split()
        if all(len(p) == 1 for p in parts) or sum(bool(re.search(_SINGLE, p)) for p in parts) >= 4:
            yield run


def restored_words(texts: pa.Array, model: np.ndarray, known: dict[str, str]) -> Words:
    """The words of every text; obfuscated ones as decoded, and the words that runs of single characters spell."""
    flat, offsets = split_words(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    coded = flat.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    raw = coded.dictionary
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(raw), TAIL, ""), EDGES)
    noisy = np.flatnonzero(pc.match_substring_regex(plain, NOISY).to_numpy(zero_copy_only=False))
    more_words: list[str] = []
    more_at: list[int] = []

    def restore(w: str) -> list[str]:
        if len(w) > 100:  # too long to remember
            return decode(w, model).split()
        if w not in known:
            if len(known) > 200_000:
                known.clear()
            known[w] = decode(w, model)
        return known[w].split()

    for i, w in zip(noisy.tolist(), plain.take(pa.array(noisy)).to_pylist()):
        for form in restore(w):
            more_at.append(i)
            more_words.append(form)
    # A restored form belongs to every document that holds the word.
    order = np.argsort(word, kind="stable")
    first = np.searchsorted(word[order], np.arange(len(raw) + 1))
    docs, words = [doc], [word]
    for j, i in enumerate(more_at):
        held = doc[order[first[i] : first[i + 1]]]
        docs.append(held)
        words.append(np.full(len(held), len(raw) + j))
    at = len(raw) + len(more_words)
    spaced = np.flatnonzero(pc.match_substring_regex(texts, SPACED).fill_null(False).to_numpy(zero_copy_only=False))
    for d in spaced.tolist():
        for run in spaced_runs(texts[d].as_py()):
            for form in restore(run):
                more_words.append(form)
                docs.append(np.array([d]))
                words.append(np.array([at]))
                at += 1
    merged = pa.concat_arrays([plain, pa.array(more_words, plain.type)])
    return Words(merged, np.concatenate(docs), np.concatenate(words))


def features_of(words: pa.Array) -> list[pa.Array]:
    """The features of every word, one array for the whole words and one for each length of beginnings (null: too short)."""
    long = pc.utf8_length(words)
    out = [pc.if_else(pc.greater_equal(long, 2), pc.binary_join_element_wise("=", words, ""), None)]
    for n in BEGINNINGS:
        out.append(pc.if_else(pc.greater(long, n), pc.binary_join_element_wise(str(n), pc.utf8_slice_codeunits(words, 0, n), ""), None))
    return out


def held_features(found: Words, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (doc, index in ``vocabulary``) of the batch."""
    pairs = [np.zeros(0, np.int64)]
    for f in features_of(found.words):
        index = pc.fill_null(pc.index_in(f, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        of = index[found.word]
        hit = of >= 0
        pairs.append(found.doc[hit] * len(vocabulary) + of[hit])
    pairs = np.unique(np.concatenate(pairs))
    return pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary))


# ---- fitting and scoring

@dataclass
class ToxicityModel:
    characters: np.ndarray  # log-probabilities of the character model
    features: list[str]
    log_odds: np.ndarray
    weights: np.ndarray  # of (1, strongest, second strongest, log of the number of strong features)


def evidence(doc: np.ndarray, index: np.ndarray, log_odds: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` documents: 1, the strongest log-odds, the second strongest, log(1 + number above 3)."""
    out = np.zeros((n, 4))
    out[:, 0] = 1
    value = log_odds[index] if len(index) else np.zeros(0)
    np.maximum.at(out[:, 1], doc, value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    second = np.flatnonzero((doc[1:] == doc[:-1]) & (np.append(doc[2:], -1) != doc[1:]))
    out[doc[second], 2] = value[second]
    out[:, 3] = np.log1p(np.bincount(doc[value > 3], minlength=n))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
                 folds: int = 5, held_out: int = 0, rows_of_class: int = 50_000, least_documents: int = 3, prior: float = 2.0) -> ToxicityModel:
    """Fit on the rows of ``df`` whose id has a label and whose crc32 fold is not ``held_out``.

    The character model counts the texts of all of ``df``.  At most
    ``rows_of_class`` labelled ids of each class are used (the first by hash of
    the id), which bounds the model too.  Every word and beginning that
    ``least_documents`` of the used documents of label 1 hold is a feature.  One fold of the labelled rows is kept for the
    logistic function.  Without labels of both classes every score is the
    share of label 1 (0 without any label).  Null ids and labels are not used.
    """
    spark = df.sparkSession
    characters = character_model(character_counts(df, text_col))
    fold = crc_mod(F.col("id"), folds)
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y")).filter(fold != held_out)
    of_class = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    empty = ToxicityModel(characters, [], np.zeros(0), np.zeros(4))
    if len(of_class) < 2:
        share = of_class.get(1, 0) / max(1, sum(of_class.values()))
        empty.weights[0] = math.log((share + 1e-6) / (1 - share + 1e-6))
        return empty
    sample = [usable.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows_of_class) for y in (0, 1)]
    last = (held_out - 1) % folds
    chosen = F.broadcast(sample[0].unionByName(sample[1]).withColumn("last", fold == last))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(chosen, "id").select("text", "y", "last")
    model = spark.sparkContext.broadcast(characters)

    def positive(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in text_slices(batches, 0, WORD_BYTES):
            found = restored_words(batch.column(0), model.value, known)
            total: Counter[str] = Counter()
            pair = np.unique(found.doc * len(found.words) + found.word)
            for f in features_of(found.words):
                # A feature counts once in a document, whatever number of its words have it.
                coded = f.dictionary_encode()
                index = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[pair % len(found.words)]
                once = np.unique((pair // len(found.words) * (len(coded.dictionary) + 1) + index)[index >= 0]) % (len(coded.dictionary) + 1)
                counts = np.bincount(once, minlength=len(coded.dictionary))
                total.update(dict(zip(coded.dictionary.to_pylist(), counts.tolist())))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["feature", "n"])

    candidates = rows.filter((F.col("y") == 1) & ~F.col("last")).mapInArrow(positive, "feature string, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= least_documents).orderBy("feature").toArrow()
    features = candidates.column("feature").to_pylist()
    shared = spark.sparkContext.broadcast(features)
    n_features = len(features)

    def negative(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        vocabulary, total, docs = pa.array(shared.value, pa.string()), np.zeros(n_features + 1, np.int64), 0
        for batch in text_slices(batches, 0, WORD_BYTES):
            _, index = held_features(restored_words(batch.column(0), model.value, known), vocabulary)
            total[:n_features] += np.bincount(index, minlength=n_features)[:n_features]
            docs += batch.num_rows
        total[n_features] = docs
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])

    counted = rows.filter((F.col("y") == 0) & ~F.col("last")).mapInArrow(negative, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    neg = np.zeros(n_features + 1)
    neg[counted.column("feature").to_numpy()] = counted.column("n").to_numpy()
    pos = candidates.column("n").to_numpy().astype(float)
    n_pos, n_neg = max(1.0, rows.filter((F.col("y") == 1) & ~F.col("last")).count()), max(1.0, neg[-1])
    share = n_pos / (n_pos + n_neg)
    log_odds = np.log((pos + prior * share) / n_pos) - np.log((neg[:-1] + prior * (1 - share)) / n_neg)
    keep = log_odds > 0.5
    found = ToxicityModel(characters, [f for f, k in zip(features, keep) if k], log_odds[keep], np.zeros(4))

    # The fold that the log-odds have not seen, a few numbers a row, at most rows_of_class of either class.
    last_fold = rows.filter("last").select("text", "y").mapInArrow(_scorer(spark, found, raw=True), "y long, x1 double, x2 double, x3 double").toArrow()
    x = np.column_stack([np.ones(len(last_fold)), *[last_fold.column(f"x{k}").to_numpy() for k in (1, 2, 3)]])
    y = last_fold.column("y").to_numpy().astype(float)
    used = {k: min(n, rows_of_class) for k, n in of_class.items()}
    found.weights = _logistic(x, y, np.where(y == 1, of_class[1] / used[1], of_class[0] / used[0]))
    return found


def _scorer(spark, model: ToxicityModel, raw: bool = False):
    """mapInArrow function: texts in the first column; the others stay, and the score (or the evidence) follows."""
    shared = spark.sparkContext.broadcast((model.features, model.characters, model.log_odds, model.weights))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, characters, log_odds, weights = shared.value
        vocabulary, known = pa.array(features, pa.string()), {}
        for batch in text_slices(batches, 0, WORD_BYTES):
            doc, index = held_features(restored_words(batch.column(0), characters, known), vocabulary)
            x = evidence(doc, index, log_odds, batch.num_rows)
            others = batch.columns[1:]
            if raw:
                yield pa.RecordBatch.from_arrays([others[0].cast(pa.int64()), *[pa.array(x[:, k]) for k in (1, 2, 3)]], names=["y", "x1", "x2", "x3"])
            else:
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([*others, pa.array(score)], names=[*batch.schema.names[1:], "score"])

    return run


def toxicity_score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``df``; the score, from 0 to 1, rests on the text alone.

    Null, empty and wordless texts get the score of no evidence.  Texts of any
    length are scored whole.  Null ids and repeated rows each give a row.
    Other columns are not read.
    """
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("id"))
    return rows.mapInArrow(_scorer(df.sparkSession, model), "id long, score double")


def without_toxic(df: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that score below ``threshold``, all columns unchanged.

    Null, empty and wordless texts have the score of no evidence; rows are
    judged one by one, so repeated rows stay or go together, and an empty
    table stays empty.  Other columns are not looked at.
    """
    scorer = _scorer(df.sparkSession, model)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], names=["text"])
            parts = [b.column(0).to_numpy() for b in scorer([batch])]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return df.filter(score(F.col(text_col).cast("string")) < threshold)
