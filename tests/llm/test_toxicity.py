import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm.toxicity import ORDER, SYMBOLS, character_counts, character_model, decode, fit_toxicity, restored_words, toxicity_score, without_toxic
from tests.llm.helpers import SF01, frame, no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    return docs, fit_toxicity(docs, spark.read.parquet(f"{SF01}/labels.parquet"))


def test_character_counts_against_plain_counting(spark):
    text = "Ab, cdé  a"
    counts = character_counts(spark.createDataFrame([(text,), (None,), ("",)], "text string"), "text")
    symbols = "   ab   cdé   a   "
    code = {" ": 0, "é": 27} | {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    wanted = np.zeros(SYMBOLS**ORDER, int)
    for i in range(len(symbols) - ORDER + 1):
        wanted[sum(code[c] * SYMBOLS ** (ORDER - 1 - k) for k, c in enumerate(symbols[i : i + ORDER]))] += 1
    assert (counts == wanted).all()
    assert np.allclose(np.exp(character_model(counts)).sum(1), 1, atol=1e-5)


def test_obfuscated_words_are_restored(fitted):
    model = fitted[1].characters
    for form in ("1d10t", "id1ot!", "i.d.i.o.t", "idiooot", "!d!ot", "1d!0t"):
        assert decode(form, model) == "idiot", form
    assert decode("m0r0n", model) == "moron" and decode("cl0wn", model) == "clown" and decode("", model) == ""


def test_viterbi_finds_the_cheapest_of_all_paths():
    """On a random model, the decoded word is the best of all combinations of the lattice."""
    from itertools import product

    from tessera.llm import toxicity as T

    model = character_model(np.random.default_rng(5).integers(0, 40, SYMBOLS**ORDER))

    def cost(choice):
        state, total = 0, 0.0
        for x, extra in choice:
            total += extra
            if x:
                total -= float(model[state, ord(x) - 96])
                state = (state * SYMBOLS + ord(x) - 96) % SYMBOLS ** (ORDER - 1)
        return total - float(model[state, 0])

    word = "6a1!0"
    options = [[(x, T.LOOK) for x in T.LOOKALIKES[c]] + [("", T.OTHER)] if c in T.LOOKALIKES else [(c, 0.0)] for c in word]
    best = min(product(*options), key=cost)
    assert decode(word, model) == "".join(x for x, _ in best)


def test_any_separators_blanks_and_doubled_letters(fitted):
    """Every form reaches the lattice, and blanks in it are dropped or word edges."""
    model = fitted[1].characters
    forms = ("i--d--i--o--t", "i..d..i..o..t", "iiddiioott", "i d i o t", "i  d  i  o  t", "i\nd\ni\no\nt", "i\td\ti\to\tt", "i\u00a0d\u00a0i\u00a0o\u00a0t",
             "i, d, i, o, t", "i - d - i - o - t", "(1 d ! 0 t)")
    for form in forms:
        assert "idiot" in restored_words(pa.array([f"so {form}."]), model, {}).words.to_pylist(), form
    assert {"idiot", "moron"} <= set(restored_words(pa.array(["i d i o t m o r o n"]), model, {}).words.to_pylist())
    assert "cat" in restored_words(pa.array(["c a t"]), character_model(np.ones(SYMBOLS**ORDER)), {}).words.to_pylist()


def test_held_out_rows(fitted):
    docs, model = fitted
    labels = dict(frame(SF01, "SELECT doc_id, toxic FROM labels").itertuples(index=False))
    scores = {r.id: r.score for r in toxicity_score(docs, model).collect()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean([(scores[d] >= 0.5) == labels[d] for d in held]) >= 0.95
    assert all(0 <= s <= 1 for s in scores.values())


def test_obfuscated_documents_are_caught_and_clean_ones_left(spark):
    model = fit_toxicity(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    clean = "Of the thing and heen anon er ou the stonti in and with that."
    rows = [(1, f"{clean} what an 1d10t {clean}"), (2, f"{clean} such a m 0 r 0 n {clean}"), (3, f"{clean} p@th3tic!!! {clean}"), (4, clean), (5, f"{clean} mail8.example.com 12.5 3e8 a b c d {clean}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r.id: r.score for r in toxicity_score(df, model).collect()}
    assert all(scores[i] >= 0.5 for i in (1, 2, 3)) and all(scores[i] < 0.5 for i in (4, 5)), scores
    assert sorted(r.doc_id for r in without_toxic(df, model).collect()) == [4, 5]


def test_odd_documents(spark, fitted):
    _, model = fitted
    odd = odd_documents(spark)
    assert len(toxicity_score(odd, model).collect()) == len(odd_rows())
    left = without_toxic(odd, model)
    assert left.columns == odd.columns and left.count() == len(odd_rows())
    assert toxicity_score(no_documents(spark), model).count() == 0 and without_toxic(no_documents(spark), model).count() == 0


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(6, 0, 0), (7, None, None), (None, 1, 1)], 0.0), ([(7, 1, 1), (7, 1, 1)], 1.0)])
def test_few_labels(spark, labels, score):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_toxicity(odd_documents(spark), labels, held_out=9)
    assert {round(r.score, 3) for r in toxicity_score(odd_documents(spark), model).collect()} == {score}
    assert toxicity_score(no_documents(spark), fit_toxicity(no_documents(spark), labels)).count() == 0


def test_words_of_texts():
    model = character_model(np.ones(SYMBOLS**ORDER))
    found = restored_words(pa.array(["A b, c.", None, "", "x##"]), model, {})
    words = found.words.to_pylist()
    assert sorted((d, words[w]) for d, w in zip(found.doc.tolist(), found.word.tolist())) == [(0, "a"), (0, "b"), (0, "c"), (3, "x")]


def test_every_state_counts_in_words_of_many_stars(monkeypatch):
    """Held one by one, in arrays, and in arrays worked twice, a word decodes alike; the cheapest path of the whole lattice."""
    from tessera.llm import toxicity as T

    rng = np.random.default_rng(8)
    model = character_model(rng.integers(0, 4, SYMBOLS**ORDER) ** 3)

    def cost_of(word, text):
        """The least cost at which the lattice of ``word`` gives ``text``."""
        at = {(0, 0): 0.0}  # letters given, state
        for options in T.lattice(word):
            new = {}
            for (n, state), cost in at.items():
                for x, extra in options:
                    if x == " ":
                        if state and n < len(text) and text[n] == " ":
                            key, total = (n + 1, 0), cost + extra - float(model[state, 0])
                        else:
                            continue
                    elif x:
                        if n >= len(text) or text[n] != x:
                            continue
                        symbol = ord(x) - 96 if x.isascii() else 27
                        key, total = (n + 1, (state * SYMBOLS + symbol) % SYMBOLS ** (ORDER - 1)), cost + extra - float(model[state, symbol])
                    else:
                        key, total = (n, state), cost + extra
                    new[key] = min(new.get(key, 1e300), total)
            at = new
        return min(c - (float(model[s, 0]) if s or not n else 0.0) for (n, s), c in at.items() if n == len(text))

    words = ["o**h*y", "f**k", "***", "a***b", "s*1*6*0", "i d * o t", "6*!*1*$", "*-*.*a*", "ab*é*c", "x" + "*" * 40 + "y"]
    words += ["".join(rng.choice(list("abcst01!6@*** .-")) for _ in range(9)).strip() for _ in range(12)]
    for word in words:
        given = []
        for few, stride in ((10**9, 64), (0, 64), (0, 2)):
            if few > 10**6 and word.count("*") > 3:
                continue  # too many to hold one by one here
            monkeypatch.setattr(T, "FEW", few)
            monkeypatch.setattr(T, "STRIDE", stride)
            given.append(decode(word, model))
        assert len({round(cost_of(" ".join(word.split()), g), 4) for g in given}) == 1, (word, given)


def test_long_words_of_stars(fitted):
    model = fitted[1].characters
    for word in ("a" + "*" * 200_000 + "b", "1d10t" * 2_000, "f*" * 300 + "k", "*" * 5_000):
        assert isinstance(decode(word, model), str)
